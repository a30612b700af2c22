"""Joins of the star schema: lookups, point in time, and the orphan mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashline.operators.placement import placed_join

# Types whose equal values have equal hashes.
_HASHABLE = (T.StringType, T.DateType, T.IntegralType)


def same_key(left: DataFrame, right: DataFrame, on: dict[str, str]) -> list[Column]:
    """Equi-join conditions with the hash of the key.

    The hash changes no result. It makes the join shuffle both sides for itself instead of
    inheriting a partitioning from a window or aggregate below, and only then can AQE split the
    partition of a hot key. The keys come first, so that rows leave the join in their order: the next
    shuffle, or a file, then has neighbours that are alike and packs them better.
    """
    equal = [left[l] == right[r] for l, r in on.items()]
    types = [(left.schema[l].dataType, right.schema[r].dataType) for l, r in on.items()]
    if all(isinstance(a, _HASHABLE) and a == b for a, b in types):
        hashes = F.xxhash64(*[left[l] for l in on]) == F.xxhash64(*[right[r] for r in on.values()])
        return [*equal, hashes]
    return equal


def with_header(
    items: DataFrame, headers: DataFrame, key: str, columns: Sequence[str], *, n_buckets: int | None = None
) -> DataFrame:
    """Items with columns of their header; items without a header are dropped.

    No hint: the header side is broadcast only if Catalyst finds it small enough, otherwise
    both sides shuffle on the key and AQE splits a key that holds very many items. With
    `n_buckets`, sides that are stored in so many buckets of the key do not shuffle.
    """
    renamed = headers.select(F.col(key).alias("__header"), *columns)
    if n_buckets:
        return placed_join(items, renamed, [(key, "__header")], "inner", n_buckets).drop("__header")
    return items.join(renamed, same_key(items, renamed, {key: "__header"}), "inner").drop("__header")


def lookup(
    df: DataFrame,
    reference: DataFrame,
    on: dict[str, str],
    columns: Sequence[str],
    *,
    small: bool = False,
    n_buckets: int | None = None,
    spread: bool = False,
) -> DataFrame:
    """Left join on `on` (left column -> reference column), adding `columns` of the reference.

    The reference must be unique in its key columns; every left row is kept once. Say `small`
    for a reference that should be broadcast if its size allows. With `n_buckets`, sides that are
    stored in so many buckets of the first key column do not shuffle; say `spread` if that column is
    NULL in many rows.
    """
    renamed = reference.select(
        *[F.col(right).alias(f"__{right}") for right in on.values()], *columns
    )
    if small:
        renamed = broadcast_if_small(renamed)
    keys = {left: f"__{right}" for left, right in on.items()}
    if n_buckets:
        return placed_join(df, renamed, list(keys.items()), "left", n_buckets, spread=spread).drop(*keys.values())
    return df.join(renamed, same_key(df, renamed, keys), "left").drop(*keys.values())


def mark_missing(
    df: DataFrame,
    reference: DataFrame,
    on: dict[str, str],
    flag: str,
    *,
    unique: bool = False,
    n_buckets: int | None = None,
) -> DataFrame:
    """Add a boolean: True where no reference row has the row's key (or a key part is NULL).

    A left join to the keys rather than NOT EXISTS: AQE can split a hot key (also the NULL key
    of all orphans) on the row-preserving side of a left join. Say `unique` where the reference
    holds each key once; that saves the shuffle that makes keys distinct. `n_buckets` is that of `lookup`.
    """
    found = f"__{flag}_found"
    keys = reference.select(*on.values()).dropna()
    keys = (keys if unique else keys.dropDuplicates()).withColumn(found, F.lit(True))
    return (
        lookup(df, keys, on, [found], n_buckets=n_buckets, spread=True)
        .withColumn(flag, F.col(found).isNull())
        .drop(found)
    )


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, None where the session does not reveal it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, TypeError):
        return None


def broadcast_limit(spark: SparkSession) -> int:
    """The session's size limit of broadcasts in bytes; -1 where they are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast for a table whose estimated size is within the session's limit, else nothing.

    For lookups with few distinct keys, such as currencies: without a broadcast, all rows of a
    currency would meet in one task. The hint changes the plan, never the rows.
    """
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= broadcast_limit(df.sparkSession) else df


def point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    *,
    key: str,
    on_date: str,
    version_id: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    strategy: str = "auto",
    disjoint: bool = False,
) -> DataFrame:
    """Left join to the versions in force on each fact's date; all facts are kept.

    A fact gets one row per version whose period holds its date, so one row in a type 2 history,
    several where periods overlap. Facts whose key or date is NULL, or outside all periods, get NULL
    columns. Periods without a start or end, or that end before they start, hold no date.

    Say `disjoint` for a history whose periods must not overlap: this saves a join, and a fact whose
    date is in a period of a key with overlapping periods raises.

    The strategy decides how, never what:

        range   equi-join with the period as residual condition. Every fact is compared with
                all versions of its key: right for a history small enough to be broadcast.
        as_of   resolves each distinct (key, date) once in one ordered pass over dates and
                version starts, then joins facts on (key, date). Work grows with facts plus
                versions however many versions a key has, one key's pass is bounded by the
                calendar, and a hot key is spread over its dates. Dates of keys whose periods
                overlap are compared with all versions of their key.
        auto    range if the history is estimated within the session's broadcast limit,
                else as_of.
    """
    if strategy == "auto":
        size = estimated_bytes(versions)
        strategy = "range" if size is not None and size <= broadcast_limit(versions.sparkSession) else "as_of"
    if strategy == "range":
        return _range_join(facts, versions, key, on_date, version_id, columns, valid_from, valid_to, disjoint)
    if strategy == "as_of":
        return _as_of_join(facts, versions, key, on_date, version_id, columns, valid_from, valid_to, disjoint)
    raise ValueError(f"unknown strategy {strategy!r}: use range, as_of or auto")


_OVERLAP = "periods overlap in a history that is said to be disjoint"


def _unless(overlap: Column, column: str) -> Column:
    return F.when(overlap, F.raise_error(F.lit(_OVERLAP))).otherwise(F.col(column)).alias(column)


def _range_join(facts, versions, key, on_date, version_id, columns, valid_from, valid_to, disjoint):
    periods = versions.select(
        F.col(version_id).alias("__id"),
        F.col(valid_from).alias("__from"),
        F.col(valid_to).alias("__to"),
        *columns,
    )
    if disjoint:
        periods = periods.filter(F.col("__from") <= F.col("__to"))
        earlier = Window.partitionBy("__id").orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
        runs_on = F.coalesce(F.max("__to").over(earlier) >= F.col("__from"), F.lit(False))
        periods = periods.withColumn("__runs_on", runs_on).withColumn(
            "__overlap", F.max("__runs_on").over(Window.partitionBy("__id"))
        )
        periods = periods.select("__id", "__from", "__to", "__overlap", *columns)
    in_force = facts[on_date].between(periods["__from"], periods["__to"])
    conditions = [*same_key(facts, periods, {key: "__id"}), in_force]
    joined = facts.join(periods, conditions, "left")
    if disjoint:
        kept = [F.col(c) for c in facts.columns]
        joined = joined.select(*kept, "__id", "__from", "__to", *[_unless(F.col("__overlap"), c) for c in columns])
    return joined.drop("__id", "__from", "__to")


def _as_of_join(facts, versions, key, on_date, version_id, columns, valid_from, valid_to, disjoint):
    asked = (
        facts.select(F.col(key).alias("__id"), F.col(on_date).alias("__day"))
        .dropna()
        .dropDuplicates()
    )
    payload = F.struct(F.col(valid_to).alias("__to"), *[F.col(c) for c in columns])
    starts = versions.filter(F.col(version_id).isNotNull() & (F.col(valid_from) <= F.col(valid_to))).select(
        F.col(version_id).alias("__id"), F.col(valid_from).alias("__day"), payload.alias("__version")
    )
    no_version = F.lit(None).cast(starts.schema["__version"].dataType)
    # On one day a start sorts before the question, so a version counts from its first day.
    in_order = Window.partitionBy("__id").orderBy("__day", "__asked")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    runs_on = F.max("__version.__to").over(earlier) >= F.col("__day")
    located = (
        starts.withColumn("__asked", F.lit(False))
        .unionByName(asked.withColumn("__version", no_version).withColumn("__asked", F.lit(True)))
        .withColumn("__in_force", F.last("__version", ignorenulls=True).over(so_far))
        .withColumn("__runs_on", F.coalesce(~F.col("__asked") & runs_on, F.lit(False)))
        .withColumn("__overlap", F.max("__runs_on").over(Window.partitionBy("__id")))
        .withColumn("__last_day", F.max("__version.__to").over(so_far))
    )
    same = lambda answers: same_key(facts, answers, {key: "__id", on_date: "__day"})
    if disjoint:
        held = located.filter(F.col("__asked") & (F.col("__day") <= F.col("__last_day")))
        held = held.select("__id", "__day", "__overlap", *[F.col(f"__in_force.{c}").alias(c) for c in columns])
        answers = held.select("__id", "__day", *[_unless(F.col("__overlap"), c) for c in columns])
        return facts.join(answers, same(answers), "left").drop("__id", "__day")
    in_force = [F.col(f"__in_force.{c}").alias(c) for c in columns]
    single = located.filter(
        F.col("__asked") & ~F.col("__overlap") & (F.col("__day") <= F.col("__in_force.__to"))
    ).select("__id", "__day", *in_force)
    # Several versions may be in force: compare with all of the key.
    overlapping = located.filter("__overlap")
    periods = overlapping.filter(~F.col("__asked")).select(
        F.col("__id").alias("__key"), F.col("__day").alias("__from"), F.col("__version").alias("__in_force")
    )
    days = overlapping.filter("__asked").select("__id", "__day")
    holds = days["__day"].between(periods["__from"], periods["__in_force.__to"])
    several = days.join(periods, [*same_key(days, periods, {"__id": "__key"}), holds]).select("__id", "__day", *in_force)
    answers = single.unionByName(several)
    return facts.join(answers, same(answers), "left").drop("__id", "__day")
