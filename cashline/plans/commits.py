"""The log of builds: what readers see.

Every build or refresh is one row, written last and in one piece, that names each table it wrote and
where. Readers resolve all their tables through one row and those before it, so they see a build
wholly or not at all, and can go back to an older one.

A table is one folder, or one folder per hash bucket of its key. A refresh writes only the buckets it
changes; the others stay where an earlier row of the same generation has put them. A table that is
written whole starts a generation of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.storage import append_rows, folders_in, remove_folder

BUILD_LOG = "_builds"
_ENTRY = "struct<table_name: string, layer: string, bucket: int, path: string, columns: string>"
BUILD_LOG_SCHEMA = f"build_id string, built_at timestamp, generation string, n_buckets int, rates string, files array<string>, tables array<{_ENTRY}>"
WHOLE = -1


@dataclass(frozen=True)
class Entry:
    """Where a build has put a table, or one bucket of it; `columns` (DDL) are those that readers see."""

    table_name: str
    layer: str
    path: str
    bucket: int = WHOLE
    columns: str | None = None


@dataclass
class Stored:
    """A table as readers find it."""

    layer: str
    generation: str
    columns: str | None = None
    paths: dict[int, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None, schema: str | None = None) -> DataFrame:
        """All of it, or some buckets. A bucketed table names its columns, so one without rows has them too."""
        wanted = self.paths if buckets is None else {b: self.paths[b] for b in buckets if b in self.paths}
        columns = schema or self.columns
        if not wanted:
            return spark.createDataFrame([], columns)
        reader = spark.read.schema(columns) if columns else spark.read
        return reader.parquet(*wanted.values())


def build_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per build that readers were pointed to."""
    try:
        return spark.read.schema(BUILD_LOG_SCHEMA).parquet(f"{out_dir}/{BUILD_LOG}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], BUILD_LOG_SCHEMA)


def commit(
    spark: SparkSession,
    out_dir: str,
    build_id: str,
    entries: Iterable[Entry],
    *,
    generation: str | None = None,
    n_buckets: int | None = None,
    rates: str | None = None,
    files: Iterable[str] = (),
) -> None:
    """Point readers to what a build wrote. Paths are relative to the output folder."""
    tables = [(e.table_name, e.layer, e.bucket, e.path, e.columns) for e in entries]
    row = (build_id, dt.datetime.now(dt.timezone.utc), generation or build_id, n_buckets, rates, list(files), tables)
    append_rows(spark, spark.createDataFrame([row], BUILD_LOG_SCHEMA), f"{out_dir}/{BUILD_LOG}")


def _up_to(spark: SparkSession, out_dir: str, build_id: str | None) -> DataFrame:
    log = build_log(spark, out_dir).withColumn("order", F.struct("built_at", "build_id"))
    if build_id is None:
        return log
    found = log.filter(F.col("build_id") == build_id).select("order").first()
    if found is None:
        raise ValueError(f"{out_dir} has no build {build_id}")
    at, name = found["order"]
    return log.filter(F.col("order") <= F.struct(F.lit(at), F.lit(name)))


def stored_tables(spark: SparkSession, out_dir: str, build_id: str | None = None) -> dict[str, Stored]:
    """Every table as of a build, the newest unless one is named.

    What reaches the driver is a path per table and bucket, however many builds the log has.
    """
    written = _up_to(spark, out_dir, build_id).select("order", "generation", F.inline("tables"))
    newest = written.groupBy("table_name").agg(F.max_by("generation", "order").alias("generation"))
    paths = written.join(newest, ["table_name", "generation"]).groupBy("table_name", "layer", "generation", "bucket")
    found: dict[str, Stored] = {}
    for r in paths.agg(F.max_by(F.struct("path", "columns"), "order").alias("at")).orderBy("table_name", "bucket").collect():
        table = found.setdefault(r["table_name"], Stored(r["layer"], r["generation"], r["at"]["columns"]))
        table.paths[r["bucket"]] = f"{out_dir}/{r['at']['path']}"
    return found


def current_tables(spark: SparkSession, out_dir: str, build_id: str | None = None) -> dict[str, DataFrame]:
    """Every table for readers, as of one build."""
    return {name: table.read(spark) for name, table in stored_tables(spark, out_dir, build_id).items() if table.layer != "state"}


def remove_old_builds(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the newest `keep` builds of a table, or of a bucket of it, needs.

    Not to be called while a build runs or readers use an older one. Names what was deleted.
    """
    written = build_log(spark, out_dir).select(F.struct("built_at", "build_id").alias("order"), "generation", F.inline("tables"))
    kept: dict[str, set[str]] = {}
    for row in written.groupBy("table_name", "layer", "bucket").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("order", "path")), asc=False), 1, keep).alias("newest")
    ).collect():
        kept.setdefault(f"{row['layer']}/{row['table_name']}", set()).update(n["path"] for n in row["newest"])
    gone = []
    for table, paths in kept.items():
        for build in folders_in(spark, f"{out_dir}/{table}"):
            path = f"{table}/{build}"
            if any(p.startswith(f"{path}/") for p in paths):
                buckets = [f"{path}/{b}" for b in folders_in(spark, f"{out_dir}/{path}")]
                gone += [b for b in buckets if b not in paths]
            elif path not in paths:
                gone.append(path)
    for path in gone:
        remove_folder(spark, f"{out_dir}/{path}")
    return gone
