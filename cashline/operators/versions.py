"""Record versions: latest per key, changes over time, and type 2 history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashline.functions import OPEN_END, add_days, fingerprint, surrogate_key
from cashline.schema import LOADED_AT, SOURCE_FILE


def load_order() -> list[Column]:
    """Newest load first; within one load, the later-named file."""
    return [F.desc_nulls_last(LOADED_AT), F.desc_nulls_last(SOURCE_FILE)]


def change_order(changed_on: str = "changed_on", created_on: str = "created_on") -> list[Column]:
    """Newest change date first (undated rows last), then newest load."""
    return [F.desc_nulls_last(F.coalesce(F.col(changed_on), F.col(created_on))), *load_order()]


def latest_version(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order. NULL keys form one group, as in SQL.

    Written as `row_number() = 1` because Spark then keeps only the best row per key in every
    map task *before* the shuffle (WindowGroupLimit): a key holding a third of all rows sends
    one row per map task, not its whole history. The keys alone lead the sort: a hash of them would
    sort faster, but each row would carry its eight bytes, which no codec makes smaller, through the shuffle.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("row_num", F.row_number().over(ranked))
        .filter(F.col("row_num") == 1)
        .drop("row_num")
    )


def latest_version_by_max(df: DataFrame, keys: Sequence[str], newest_last: Sequence[str]) -> DataFrame:
    """The same for ascending columns without NULLs, as an aggregate with map-side combine."""
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*newest_last))
    return df.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*")


def one_per_day(
    history: DataFrame, *, key: str, day: str, order_by: Sequence[Column]
) -> DataFrame:
    """One row per key and day. After this a key holds at most one row per calendar day."""
    if not isinstance(history.schema[day].dataType, T.DateType):
        raise TypeError(f"{day} must be a date: the day grain bounds the rows per key")
    return latest_version(history, [key, day], order_by)


def attribute_changes(
    daily: DataFrame, *, key: str, day: str, attributes: Sequence[str]
) -> DataFrame:
    """The days on which a key's attributes differ from its previous row.

    Takes one row per key and day, so the window over one key is bounded by the calendar.
    Adds `attributes`, the fingerprint that was compared.
    """
    in_order = Window.partitionBy(key).orderBy(day)
    previous = F.col("previous_attributes")
    return (
        daily.withColumn("attributes", fingerprint(*attributes))
        .withColumn("previous_attributes", F.lag("attributes").over(in_order))
        .filter(previous.isNull() | (previous != F.col("attributes")))
        .drop("previous_attributes")
    )


def scd2(
    history: DataFrame,
    *,
    key: str,
    attributes: Sequence[str],
    valid_from: str = "valid_from",
    order_by: Sequence[Column] = (),
    version_key: str = "version_key",
) -> DataFrame:
    """Type 2 history: one row per period in which a key's attributes stayed the same.

    Several rows of one day collapse to the first in `order_by`; rows equal in that order are
    told apart by their attributes, so a rerun gives the same history. A version ends the day
    before the next one starts.
    """
    daily = daily_states(history, key=key, attributes=attributes, valid_from=valid_from, order_by=order_by)
    return versions_of(daily, key=key, attributes=attributes, valid_from=valid_from, version_key=version_key)


def daily_states(
    history: DataFrame, *, key: str, attributes: Sequence[str], valid_from: str = "valid_from", order_by: Sequence[Column] = ()
) -> DataFrame:
    """One row per key and day on which anything was heard of it, the first in `order_by`."""
    told_apart = [F.desc(fingerprint(*attributes)), *[F.desc_nulls_last(a) for a in attributes]]
    return one_per_day(history, key=key, day=valid_from, order_by=[*order_by, *told_apart])


def versions_of(
    daily: DataFrame, *, key: str, attributes: Sequence[str], valid_from: str = "valid_from", version_key: str = "version_key"
) -> DataFrame:
    """The periods in which a key's attributes stayed the same, from one row per key and day."""
    changes = attribute_changes(
        daily.select(key, *attributes, valid_from), key=key, day=valid_from, attributes=attributes
    )
    next_start = F.lead(valid_from).over(Window.partitionBy(key).orderBy(valid_from))
    return changes.withColumn("next_start", next_start).select(
        surrogate_key(key, valid_from).alias(version_key),
        key,
        *attributes,
        valid_from,
        F.coalesce(add_days("next_start", -1), F.lit(OPEN_END)).alias("valid_to"),
        F.col("next_start").isNull().alias("is_current"),
    )


def changed_periods(
    before: DataFrame, after: DataFrame, *, key: str, version_key: str, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """The days (key, first_day, last_day) on which another version is in force after a change than before.

    Both are type 2 histories of the same keys. Between two starts of either nothing changes, so each start
    is looked at once, in one ordered pass over those of its key: the versions in force from there are
    compared, and the days up to the next start count if they differ. A version that only ends sooner
    keeps the days it keeps.
    """

    def starts(history: DataFrame, side: int) -> DataFrame:
        version = F.struct(F.col(version_key).alias("id"), F.col(valid_to).alias("upto"))
        none = F.lit(None).cast(f"struct<id: {history.schema[version_key].dataType.simpleString()}, upto: date>")
        both = [version, none] if side == 0 else [none, version]
        return history.select(F.col(key), F.col(valid_from).alias("first_day"), both[0].alias("old"), both[1].alias("new"))

    # A start of both sides on one day is one row, so that the window over a key is bounded by the calendar.
    days = starts(before, 0).unionByName(starts(after, 1)).groupBy(key, "first_day").agg(
        F.max("old").alias("old"), F.max("new").alias("new")
    )
    in_order = Window.partitionBy(key).orderBy("first_day")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_force = [
        F.when(F.col(f"{side}.upto") >= F.col("first_day"), F.col(f"{side}.id")).alias(side) for side in ("old", "new")
    ]
    located = days.select(
        key,
        "first_day",
        *[F.last(side, ignorenulls=True).over(so_far).alias(side) for side in ("old", "new")],
        F.coalesce(add_days(F.lead("first_day").over(in_order), -1), F.lit(OPEN_END)).alias("last_day"),
    )
    differs = located.select(key, "first_day", "last_day", *in_force).filter(~F.col("old").eqNullSafe(F.col("new")))
    return differs.select(key, "first_day", "last_day")
