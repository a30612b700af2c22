"""The raw layer: append-only text tables with lineage, and the log of loaded files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashline.schema import LOAD_LOG, LOADED_AT, RAW_COLUMNS, SOURCE_FILE, raw_struct
from cashline.session import work_folder
from cashline.sources.extracts import (
    MAX_RECORD_BYTES,
    Extract,
    LoadError,
    discover,
    inspect_files,
    scan,
)
from cashline.sources.claims import EXPIRES, Claims
from cashline.storage import append_rows, remove_folder

LOG_NAME = "_load_log"


@dataclass(frozen=True)
class LoadResult:
    """What a load did."""

    files_loaded: int = 0
    files_skipped: int = 0
    rows_loaded: int = 0
    files_claimed: int = 0  # by loads that were not finished with them

    def __str__(self) -> str:
        claimed = f", left {self.files_claimed} to other loads" if self.files_claimed else ""
        return f"loaded {self.files_loaded} files ({self.rows_loaded} rows), skipped {self.files_skipped}{claimed}"


def _read_or_empty(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def load_log(spark: SparkSession, raw_dir: str) -> DataFrame:
    """One row per loaded file, also for files without rows."""
    return _read_or_empty(spark, LOAD_LOG, f"{raw_dir}/{LOG_NAME}")


def raw_table(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """Every version of every record of one extract table, all text, with lineage.

    Only files in the load log count, so a load that died halfway shows nothing of the files
    it had not finished. The log has one row per file, and the join prunes partitions.
    """
    rows = _read_or_empty(spark, raw_struct(table), f"{raw_dir}/{table}")
    finished = load_log(spark, raw_dir).select(F.col("file_name").alias(SOURCE_FILE))
    return rows.join(finished, SOURCE_FILE, "left_semi").select(
        *RAW_COLUMNS[table], LOADED_AT, SOURCE_FILE
    )


def raw_tables(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    return {table: raw_table(spark, raw_dir, table) for table in RAW_COLUMNS}


def not_yet_loaded(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files whose name is not in the load log."""
    return files.join(log.select("file_name"), "file_name", "left_anti")


def load_extracts(
    spark: SparkSession,
    extracts_dir: str,
    raw_dir: str,
    *,
    max_record_bytes: int = MAX_RECORD_BYTES,
    claim_expires: float = EXPIRES,
) -> LoadResult:
    """Load every extract file that has not been loaded yet. Running it again adds nothing.

    All new files are checked first. Good ones are loaded and logged; if any were bad, one
    LoadError then names them all, and nothing of a bad file is kept. A file with a record of more
    than `max_record_bytes` bytes is bad, on one line or on several.

    Several loads may run at once: each file is loaded by the one that claims it first, and the others
    leave it. A claim whose load has died holds for `claim_expires` seconds, which must be more than a
    load takes.
    """
    files = discover(spark, extracts_dir)
    return load_files(spark, files, raw_dir, max_record_bytes=max_record_bytes, claim_expires=claim_expires)


def load_files(
    spark: SparkSession,
    files: DataFrame,
    raw_dir: str,
    *,
    max_record_bytes: int = MAX_RECORD_BYTES,
    claim_expires: float = EXPIRES,
) -> LoadResult:
    """The same for the files (table_name, file_name, path) that are named."""
    n_files = files.count()
    wanted = _listing(spark, files, raw_dir)
    claims = Claims(spark, raw_dir, claim_expires)
    scratch = f"{work_folder(spark, raw_dir)}/load-{uuid4().hex}"
    try:
        own = claims.take(name for _, name, _ in wanted)
        # Another load may have finished a file after we looked, and before we claimed it.
        fresh = {row[1] for row in _listing(spark, files, raw_dir)} if own else set()
        listing = [row for row in wanted if row[1] in own & fresh]
        good, problems = inspect_files(spark, listing, scratch, max_record_bytes)
        rows = _append(spark, good, raw_dir, scratch, claims)
    finally:
        claims.give_back()
        remove_folder(spark, scratch)
    if problems:
        raise LoadError("; ".join(f"{path}: {text}" for path, text in sorted(problems.items())))
    claimed = len(wanted) - len(own)
    return LoadResult(len(good), n_files - len(listing) - claimed, rows, claimed)


def _listing(spark: SparkSession, files: DataFrame, raw_dir: str) -> list[tuple[str, str, str]]:
    """Table, name and path of the files not in the log: names of new files only, no contents."""
    new = not_yet_loaded(files, load_log(spark, raw_dir)).select("table_name", "file_name", "path")
    return [tuple(row) for row in new.collect()]


def _append(
    spark: SparkSession, files: list[Extract], raw_dir: str, scratch: str, claims: Claims, threads: int = 4
) -> int:
    """Write data, verify it, then log it. Dying in between costs only a repeated write:

    each file owns one partition, which a rerun replaces. Tables are written side by side.
    """
    if not files:
        return 0
    loaded_at = dt.datetime.now(dt.timezone.utc)
    by_table: dict[str, list[Extract]] = {}
    for file in files:
        by_table.setdefault(file.table, []).append(file)

    def write(table: str) -> None:
        (
            scan(spark, table, by_table[table], scratch)
            .withColumn(LOADED_AT, F.lit(loaded_at))
            .select(*RAW_COLUMNS[table], LOADED_AT, SOURCE_FILE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SOURCE_FILE)
            .parquet(f"{raw_dir}/{table}")
        )
        _verify(spark, table, by_table[table], raw_dir)

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), by_table))
    if lost := claims.lost():
        raise LoadError(f"{raw_dir}: other loads have claimed {', '.join(lost)} as this one took longer than its claims hold")
    entries = [(f.file_name, f.table, f.row_count, loaded_at) for f in files]
    append_rows(spark, spark.createDataFrame(entries, LOAD_LOG), f"{raw_dir}/{LOG_NAME}")
    return sum(f.row_count for f in files)


def _verify(spark: SparkSession, table: str, files: Iterable[Extract], raw_dir: str) -> None:
    """The rows written per file must be the rows counted when the file was checked."""
    expected = spark.createDataFrame(
        [(f.file_name, f.row_count) for f in files], f"{SOURCE_FILE} string, expected bigint"
    )
    written = _read_or_empty(spark, raw_struct(table), f"{raw_dir}/{table}").join(
        expected.select(SOURCE_FILE), SOURCE_FILE, "left_semi"
    )
    counts = written.groupBy(SOURCE_FILE).agg(F.count("*").alias("n"))
    got = F.coalesce("n", F.lit(0))
    wrong = expected.join(counts, SOURCE_FILE, "left").filter(got != F.col("expected"))
    rows = wrong.select(SOURCE_FILE, got.alias("n"), "expected").collect()
    if rows:
        text = ", ".join(f"{r[SOURCE_FILE]} has {r['n']} of {r['expected']} rows" for r in rows)
        raise LoadError(f"{raw_dir}/{table}: {text}")
