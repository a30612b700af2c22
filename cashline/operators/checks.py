"""Data-quality checks. A check is a query for offending rows; it passes when there are none."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"


def duplicate_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count. NULL keys do not count."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n_records")).filter(
        F.col("n_records") > 1
    )


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list, with their count. NULL passes."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def missing_parents(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row, with their number of child rows. NULL passes.

    Both sides are reduced to distinct values first, so a hot value reaches the join as one row.
    """
    values = child.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n_records"))
    known = parent.select(F.col(parent_column).alias("__parent")).dropna().dropDuplicates()
    return values.join(known, values[column] == known["__parent"], "left_anti")


def overlapping_versions(
    versions: DataFrame,
    *,
    key: str,
    version_key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Version starts at which a period of the same key already runs.

    One row per start instead of one per pair: if any two periods overlap, then the later
    start is reported with the earlier-started period that runs longest. Periods must not end
    before they start. Starts of one day are combined before the window, so the window over
    one key is bounded by the calendar.
    """
    by_day = versions.groupBy(key, valid_from).agg(
        F.max(F.struct(valid_to, version_key)).alias("longest"),
        F.min(version_key).alias("first_key"),
        F.max(version_key).alias("last_key"),
    )
    earlier = (
        Window.partitionBy(key)
        .orderBy(valid_from)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    runs_on = F.col(f"running.{valid_to}") >= F.col(valid_from)
    same_day = F.col("first_key") < F.col("last_key")
    return (
        by_day.withColumn("running", F.max("longest").over(earlier))
        .filter(runs_on | same_day)
        .select(
            key,
            F.col("last_key").alias(version_key),
            F.when(runs_on, F.col(f"running.{version_key}"))
            .otherwise(F.col("first_key"))
            .alias(f"overlapping_{version_key}"),
        )
    )


@dataclass(frozen=True)
class KeyUse:
    """A column that a check looks at as a key: of the parent rows, or of child rows that need a parent."""

    parent: tuple[str, str]  # table and column
    frame: Callable[[], DataFrame]
    column: str


@dataclass(frozen=True)
class Check:
    """A named query for offending rows. `counted` sums a count column instead of rows.

    `key` says that the check is about a key, and shares the counting of its values with others.
    """

    name: str
    table: str
    kind: str
    violations: Callable[[], DataFrame]
    severity: str = ERROR
    counted: str | None = None
    key: KeyUse | None = None

    def summary(self) -> DataFrame:
        total = (
            F.coalesce(F.sum(self.counted), F.lit(0)) if self.counted else F.count("*")
        ).cast("bigint")
        counted = self.violations().agg(total.alias("n_violations"))
        return counted.select(
            F.lit(self.name).alias("check_name"),
            F.lit(self.table).alias("table_name"),
            F.lit(self.kind).alias("kind"),
            F.lit(self.severity).alias("severity"),
            "n_violations",
        )


@dataclass(frozen=True)
class Pass:
    """Checks of one frame that a single pass over it answers.

    `not_null` columns count their NULL rows, `accepted` columns their distinct values outside the list
    (NULL passes), `rules` the rows in which an SQL condition holds, by check name. `frame` may be a join that
    several rules share.
    """

    table: str
    frame: Callable[[], DataFrame]
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)

    def summary(self) -> DataFrame:
        df = self.frame()
        counted = {f"not_null_{self.table}_{c}": ("not_null", F.col(c).isNull()) for c in self.not_null}
        counted |= {name: ("business_rule", F.coalesce(F.expr(condition), F.lit(False))) for name, condition in self.rules.items()}
        marks = [F.when(hit, 1).otherwise(0).cast("bigint").alias(f"c{n}") for n, (_, hit) in enumerate(counted.values())]
        odd = {
            f"accepted_values_{self.table}_{c}": F.when(~F.col(c).isin(*values), F.col(c)).alias(f"v{n}")
            for n, (c, values) in enumerate(self.accepted.items())
        }
        # Rows are summed per combination of unaccepted values, of which good data have one; only
        # these few rows are left to count values in.
        by_value = df.select(*marks, *odd.values()).groupBy(*[f"v{n}" for n in range(len(odd))]).agg(
            F.count("*").alias("n"), *[F.sum(f"c{n}").alias(f"c{n}") for n in range(len(counted))]
        )
        totals = by_value.agg(
            F.count("*").alias("groups"),
            *[F.coalesce(F.sum(f"c{n}"), F.lit(0)).alias(f"c{n}") for n in range(len(counted))],
            *[F.count_distinct(f"v{n}").alias(f"v{n}") for n in range(len(odd))],
        )
        found = [(name, kind, f"c{n}") for n, (name, (kind, _)) in enumerate(counted.items())]
        found += [(name, "accepted_values", f"v{n}") for n, name in enumerate(odd)]
        rows = [
            F.struct(F.lit(name).alias("check_name"), F.lit(kind).alias("kind"), F.col(c).alias("n_violations"))
            for name, kind, c in found
        ]
        return totals.select(F.explode(F.array(*rows)).alias("r")).select(
            "r.check_name",
            F.lit(self.table).alias("table_name"),
            "r.kind",
            F.lit(ERROR).alias("severity"),
            "r.n_violations",
        )


@dataclass(frozen=True)
class SharedKeys:
    """The checks about one key: that parents have it once, and that children have a parent with it.

    Every value is counted once per column that holds it, all in one aggregation that combines in the map
    tasks: one shuffle for all these checks, in which a value that a third of all children have is one row
    per task.
    """

    parent: KeyUse
    unique: Check | None
    children: Sequence[Check]

    def summary(self) -> DataFrame:
        uses = [self.parent, *[c.key for c in self.children]]
        ones = [F.lit(1).cast("bigint"), F.lit(0).cast("bigint")]

        def values(place: int, use: KeyUse) -> DataFrame:
            marks = [ones[place != n].alias(f"n{n}") for n in range(len(uses))]
            return use.frame().select(F.col(use.column).alias("value"), *marks).dropna(subset=["value"])

        every = reduce(DataFrame.union, [values(n, use) for n, use in enumerate(uses)])
        by_value = every.groupBy("value").agg(*[F.sum(f"n{n}").alias(f"n{n}") for n in range(len(uses))])
        orphan = F.col("n0") == 0
        found = [(check, F.sum(F.when(orphan, F.col(f"n{n}")))) for n, check in enumerate(self.children, 1)]
        if self.unique:
            found.append((self.unique, F.sum(F.when(F.col("n0") > 1, 1))))
        totals = by_value.agg(*[F.coalesce(total, F.lit(0)).cast("bigint").alias(f"c{n}") for n, (_, total) in enumerate(found)])
        rows = [
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.lit(check.table).alias("table_name"),
                F.lit(check.kind).alias("kind"),
                F.lit(check.severity).alias("severity"),
                F.col(f"c{n}").alias("n_violations"),
            )
            for n, (check, _) in enumerate(found)
        ]
        return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def share_keys(checks: Sequence[Check], parents: Mapping[tuple[str, str], KeyUse]) -> list[Check | SharedKeys]:
    """The same checks, those about one key as one. `parents` has the key column of each parent table.

    A child column of another type than its parent's is left to a check of its own.
    """
    alone: list[Check | SharedKeys] = []
    by_key: dict[tuple[str, str], list[Check]] = {}
    for check in checks:
        if check.key and check.key.parent in parents:
            by_key.setdefault(check.key.parent, []).append(check)
        else:
            alone.append(check)
    for key, found in by_key.items():
        own = parents[key]
        unique = [c for c in found if c.kind == "unique"]
        same = own.frame().schema[own.column].dataType
        children = [c for c in found if c not in unique and c.key.frame().schema[c.key.column].dataType == same]
        alone += [c for c in found if c not in unique and c not in children]
        alone.append(SharedKeys(own, unique[0] if unique else None, children))
    return alone


def with_status(summary: DataFrame) -> DataFrame:
    """Add `status`: pass, warn or fail."""
    status: Column = (
        F.when(F.col("n_violations") == 0, "pass")
        .when(F.col("severity") == WARN, "warn")
        .otherwise("fail")
    )
    return summary.withColumn("status", status)


def run_checks(
    spark: SparkSession, checks: Sequence[Check | SharedKeys], passes: Sequence[Pass] = ()
) -> DataFrame:
    """One row per check: name, table, kind, severity, number of violations, status."""
    parts = [check.summary() for check in [*passes, *checks]]
    if not parts:
        return spark.createDataFrame(
            [],
            "check_name string, table_name string, kind string, severity string, "
            "n_violations bigint, status string",
        )
    return with_status(reduce(DataFrame.unionByName, parts))
