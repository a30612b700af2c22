"""Daily CSV extracts: discovery, structural checks, and an exact all-text scan.

A file may be far larger than one task should read, so nothing here treats a file as a unit of
work. Files are scanned as lines in splits. A file whose every line is a whole record goes
through the splittable CSV reader; only files with line breaks inside quotes have their records
put together from lines first, also split by split.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashline.schema import RAW_COLUMNS, SOURCE_FILE, text_struct
from cashline.storage import empty_files

# The longest record in bytes that a load takes unless told otherwise. It also bounds the lines that
# are ever put together into one record.
MAX_RECORD_BYTES = 2_000_000

CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# One field: quoted with doubled quotes inside, or text not starting with a quote, or empty.
# Possessive throughout, so long fields neither backtrack nor recurse.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",][^,]*+|)'
_WHOLE_RECORD = rf"^{_FIELD}(?:,{_FIELD})*+\z"
_QUOTED_FIELD = r'(^|,)"(?:[^"]++|"")*+"'
# A line that ends inside quotes, by whether it began outside or inside them.
_OPEN_TAIL = rf'(?:{_FIELD},)*+"(?:[^"]++|"")*+\z'
_OPEN_AFTER_CLOSED = rf"^{_OPEN_TAIL}"
_OPEN_AFTER_OPEN = rf'^(?:[^"]++|"")*+(?:\z|",{_OPEN_TAIL})'


class LoadError(Exception):
    """A file or folder could not be loaded; the message names it."""


@dataclass(frozen=True)
class Extract:
    """One extract file that passed its checks."""

    table: str
    file_name: str
    path: str
    header: tuple[str, ...]
    one_line_records: bool
    row_count: int


def table_folders(extracts_dir: str) -> str:
    """Glob over the table folders of an extracts folder."""
    return f"{str(extracts_dir).rstrip('/')}/{{{','.join(RAW_COLUMNS)}}}"


def discover(spark: SparkSession, extracts_dir: str) -> DataFrame:
    """All extract files `<dir>/<TABLE>/<TABLE>_*.csv` as (table_name, file_name, path).

    A frame over Spark's own listing: no file is read and no name collected, but for those of files of
    length zero, which the listing leaves out.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        listing = reader.load(table_folders(extracts_dir)).select("path")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        try:
            reader.load(str(extracts_dir))
        except AnalysisException:
            raise LoadError(f"there is no folder of extracts at {extracts_dir}") from None
        return spark.createDataFrame([], "table_name string, file_name string, path string")
    return named_extracts(listing.union(empty_extracts(spark, extracts_dir)))


def empty_extracts(spark: SparkSession, extracts_dir: str) -> DataFrame:
    """Paths of the extract files of length zero, which Spark's listings leave out."""
    empty = empty_files(spark, f"{table_folders(extracts_dir)}/*.csv")
    return spark.createDataFrame([(p,) for p in empty], "path string")


def named_extracts(paths: DataFrame) -> DataFrame:
    """Those of the paths that are extract files, as (table_name, file_name, path)."""
    parts = F.split("path", "/")
    named = paths.select(
        F.element_at(parts, -2).alias("table_name"), F.element_at(parts, -1).alias("file_name"), "path"
    )
    return named.filter(F.startswith("file_name", F.concat("table_name", F.lit("_"))))


def _lines(spark: SparkSession, paths: Sequence[str], line_sep: str | None = None) -> DataFrame:
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(list(paths)).select(
        "value",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )


def _count_of(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _field_count(record: Column) -> Column:
    bare = F.when(
        F.contains(record, F.lit('"')), F.regexp_replace(record, _QUOTED_FIELD, "$1")
    ).otherwise(record)
    return _count_of(bare, ",") + 1


def _is_whole(record: Column) -> Column:
    return ~F.contains(record, F.lit('"')) | F.rlike(record, F.lit(_WHOLE_RECORD))


def line_facts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row of structural facts per file, from a single scan over its lines.

    Everything aggregated is a number, so the scan combines map-side in a hash table. The
    header is known by its hash; its text is fetched only where that is not the usual one.
    """
    value = F.col("value")
    at_start = F.when(F.col("block") == 0, F.col("position"))
    fields = F.when(value != "", _field_count(value))
    return (
        _lines(spark, paths)
        .groupBy("file_name")
        .agg(
            F.count(F.when(value != "", 1)).alias("n_lines"),
            F.count(F.when(~F.is_valid_utf8(value), 1)).alias("n_not_utf8"),
            F.count(F.when(~_is_whole(value), 1)).alias("n_partial"),
            F.max(F.octet_length(value)).alias("longest"),
            F.min(fields).alias("fewest"),
            F.max(fields).alias("most"),
            F.min_by(F.xxhash64(value), at_start).alias("header_hash"),
        )
    )


def _header_problem(table: str, header: Sequence[str]) -> str | None:
    expected = RAW_COLUMNS[table]
    missing = sorted(set(expected) - set(header))
    extra = sorted(set(header) - set(expected))
    if missing or extra:
        return f"the header of {table} has {len(header)} columns: {missing} lacking, {extra} unknown"
    if len(header) != len(expected):
        return f"the header of {table} repeats columns: {list(header)}"
    return None


def inspect_files(
    spark: SparkSession,
    files: Iterable[tuple[str, str, str]],
    folder: str,
    max_record_bytes: int = MAX_RECORD_BYTES,
) -> tuple[list[Extract], dict[str, str]]:
    """Check (table, file name, path) triples: good files, and problems by path.

    Only per-file facts come to the driver, never file contents. `folder` takes scratch tables.
    """
    listed = sorted(files)
    if not listed:
        return [], {}
    facts = {r["file_name"]: r for r in line_facts(spark, [path for _, _, path in listed]).collect()}
    headers = _headers(spark, listed, facts)
    good: list[Extract] = []
    open_files: list[Extract] = []
    problems: dict[str, str] = {}
    for table, name, path in listed:
        fact = facts.get(name)
        if fact is not None and fact["n_not_utf8"]:
            problems[path] = f"{fact['n_not_utf8']} lines of {table} are not UTF-8"
            continue
        header = headers[path] if fact else []
        problem = _header_problem(table, header)
        if problem:
            problems[path] = problem
        elif fact["longest"] > max_record_bytes:
            problems[path] = _too_long(max_record_bytes)
        elif fact["n_partial"]:
            open_files.append(Extract(table, name, path, tuple(header), False, 0))
        elif (fact["fewest"], fact["most"]) != (len(header), len(header)):
            problems[path] = (
                f"rows of {fact['fewest']} to {fact['most']} fields, expected {len(header)}"
            )
        else:
            good.append(Extract(table, name, path, tuple(header), True, fact["n_lines"] - 1))
    if open_files:
        checked, more = _inspect_open_files(spark, open_files, folder, max_record_bytes)
        good += checked
        problems.update(more)
    return good, problems


def _too_long(limit: int) -> str:
    return f"a record is longer than {limit} bytes"


def _headers(
    spark: SparkSession, listed: Sequence[tuple[str, str, str]], facts: dict
) -> dict[str, list[str]]:
    """Column names by path: the usual ones by their hash, all others fetched in one query."""
    usual = [F.xxhash64(F.lit(",".join(c))).alias(t) for t, c in RAW_COLUMNS.items()]
    hashes = spark.range(1).select(*usual).first().asDict()
    found = {p: RAW_COLUMNS[t] for t, n, p in listed if n in facts and facts[n]["header_hash"] == hashes[t]}
    others = {n: p for _, n, p in listed if n in facts and p not in found}
    if others:
        lines = _lines(spark, list(others.values())).filter(F.col("block") == 0)
        first = lines.groupBy("file_name").agg(F.min_by("value", "position").alias("header"))
        for row in first.collect():
            found[others[row["file_name"]]] = next(csv.reader([row["header"]]), [])
    return {p: list(found.get(p, [])) for _, _, p in listed}


def record_lines(lines: DataFrame) -> DataFrame:
    """Lines of files with quoted line breaks, each with the record it belongs to.

    Takes (file_name, block, position, value); adds the start of the line's record and whether
    it is the file's first line. Whether a line begins inside quotes depends on all lines
    before it, so each line is reduced to what it does to that state, then each split, and only
    the few split totals are ordered per file.
    """
    split_key = ["file_name", "block"]
    by_position = Window.partitionBy(*split_key).orderBy("position")
    by_block = Window.partitionBy("file_name").orderBy("block")
    effects = _running_effect(
        lines.withColumn("out_to", _ends_open(F.col("value"), False))
        .withColumn("in_to", _ends_open(F.col("value"), True))
        .withColumn("number", F.row_number().over(by_position)),
        by_position,
    )
    split_effects = effects.groupBy(*split_key).agg(
        F.max(F.struct("position", "out_to_so_far", "in_to_so_far")).alias("whole")
    )
    entered = (
        _running_effect(
            split_effects.select(
                *split_key,
                F.col("whole.out_to_so_far").alias("out_to"),
                F.col("whole.in_to_so_far").alias("in_to"),
            ),
            by_block,
        )
        .withColumn("entered_open", F.lag("out_to_so_far", 1, 0).over(by_block))
        .select(*split_key, "entered_open")
    )
    open_before = F.when(F.col("number") == 1, F.col("entered_open")).otherwise(
        F.when(F.col("entered_open") == 0, F.lag("out_to_so_far").over(by_position)).otherwise(
            F.lag("in_to_so_far").over(by_position)
        )
    )
    here = F.struct("block", "position")
    located = (
        effects.join(entered, split_key)
        .withColumn("starts", open_before == 0)
        .withColumn(
            "own_start", F.last(F.when(F.col("starts"), here), ignorenulls=True).over(by_position)
        )
    )
    # Lines at the head of a split may continue the last record of an earlier split.
    carried = (
        located.groupBy(*split_key)
        .agg(F.max("own_start").alias("last_start"))
        .withColumn(
            "carried",
            F.last("last_start", ignorenulls=True).over(
                by_block.rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*split_key, "carried")
    )
    return located.join(carried, split_key).select(
        *split_key,
        "position",
        "value",
        F.coalesce("own_start.block", "carried.block").alias("record_block"),
        F.coalesce("own_start.position", "carried.position").alias("record_position"),
        ((F.col("block") == 0) & (F.col("number") == 1)).alias("is_first"),
    )


def _ends_open(line: Column, begins_open: bool) -> Column:
    """1 if a line leaves a quoted field open at its end, else 0."""
    text = F.regexp_replace(line, "\r\\z", "")
    pattern = _OPEN_AFTER_OPEN if begins_open else _OPEN_AFTER_CLOSED
    return F.rlike(text, F.lit(pattern)).cast("int")


def _running_effect(df: DataFrame, in_order: Window) -> DataFrame:
    """Compose `out_to`/`in_to` (state after a row, by state before it) over all rows so far.

    A row either decides the state, flips it, or leaves it. So the composition is the last
    decision, flipped as often as flips follow it.
    """
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decides = F.col("out_to") == F.col("in_to")
    flip = F.when(~decides & (F.col("out_to") == 1), 1).otherwise(0)
    decision = F.struct(F.col("out_to").alias("state"), F.col("flips").alias("flips"))
    since = F.col("flips") - F.coalesce("decided.flips", F.lit(0))

    def ending(entry: int) -> Column:
        return F.pmod(F.coalesce("decided.state", F.lit(entry)) + since, F.lit(2)).cast("int")

    return (
        df.withColumn("flips", F.sum(flip).over(so_far))
        .withColumn("decided", F.last(F.when(decides, decision), ignorenulls=True).over(so_far))
        .withColumn("out_to_so_far", ending(0))
        .withColumn("in_to_so_far", ending(1))
        .drop("flips", "decided")
    )


RECORD = ["file_name", "record_block", "record_position"]


def _joined_records(lines: DataFrame) -> DataFrame:
    """(file_name, record, is_header): the lines of each record put back together.

    The records of a split stay together, so a task writes few files afterwards, and a huge
    file is still spread over as many tasks as it has splits.
    """
    in_order = F.sort_array(F.collect_list(F.struct("block", "position", "value")))
    return (
        lines.repartition("file_name", "record_block")
        .groupBy(*RECORD)
        .agg(
            F.array_join(F.transform(in_order, lambda line: line["value"]), "\n").alias("joined"),
            F.max("is_first").alias("is_header"),
        )
        .select("file_name", F.regexp_replace("joined", "\r\\z", "").alias("record"), "is_header")
        .filter(F.col("record") != "")
    )


def _materialized_lines(
    spark: SparkSession, files: Sequence[Extract], folder: str, name: str
) -> DataFrame:
    """The lines of some files, written once so that their positions are fixed.

    Positions come from how a scan is split, which another scan or a retry may do differently.
    """
    path = f"{folder}/{name}"
    lines = _lines(spark, [f.path for f in files], line_sep="\n")
    lines.write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def _inspect_open_files(
    spark: SparkSession, files: list[Extract], folder: str, max_record_bytes: int
) -> tuple[list[Extract], dict[str, str]]:
    """Check files with quoted line breaks record by record."""
    lines = record_lines(_materialized_lines(spark, files, folder, "check"))
    sizes = (
        lines.groupBy(*RECORD)
        .agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
        .groupBy("file_name")
        .agg(F.max("bytes").alias("longest"))
    )
    refused = sizes.filter(F.col("longest") > max_record_bytes).select("file_name")
    # Without the files just refused, every record is small enough to be put together.
    record = F.col("record")
    facts = (
        _joined_records(lines.join(refused, "file_name", "left_anti"))
        .groupBy("file_name")
        .agg(
            F.count("*").alias("n_records"),
            F.count(F.when(~_is_whole(record), 1)).alias("n_malformed"),
            F.min(_field_count(record)).alias("fewest"),
            F.max(_field_count(record)).alias("most"),
        )
    )
    fact_by_file = {r["file_name"]: r for r in facts.collect()}
    good: list[Extract] = []
    problems: dict[str, str] = {}
    for file in files:
        fact, width = fact_by_file.get(file.file_name), len(file.header)
        if fact is None:
            problems[file.path] = _too_long(max_record_bytes)
        elif fact["n_malformed"]:
            problems[file.path] = f"{fact['n_malformed']} rows with misplaced or unclosed quotes"
        elif (fact["fewest"], fact["most"]) != (width, width):
            problems[file.path] = (
                f"rows of {fact['fewest']} to {fact['most']} fields, expected {width}"
            )
        else:
            good.append(replace(file, row_count=fact["n_records"] - 1))
    return good, problems


def _exact_text(column: str) -> Column:
    """Empty fields as empty text, quoted or not; only the literal \\N is NULL."""
    return F.nullif(F.coalesce(F.col(column), F.lit("")), F.lit("\\N")).alias(column)


def scan(spark: SparkSession, table: str, files: Sequence[Extract], folder: str) -> DataFrame:
    """All rows of checked files of one table: schema columns as text, then the file name.

    Files may order their columns differently; each layout is read by its own header.
    """
    layouts: dict[tuple[tuple[str, ...], bool], list[Extract]] = {}
    for file in files:
        layouts.setdefault((file.header, file.one_line_records), []).append(file)
    open_files = [f for f in files if not f.one_line_records]
    lines = _materialized_lines(spark, open_files, folder, table) if open_files else None
    parts = []
    for (header, one_line_records), members in layouts.items():
        if one_line_records:
            rows = (
                spark.read.schema(text_struct(list(header)))
                .options(header="true", enforceSchema="false", **CSV_OPTIONS)
                .csv([f.path for f in members])
                .select("*", F.col("_metadata.file_name").alias(SOURCE_FILE))
            )
        else:
            of_layout = spark.createDataFrame([(f.file_name,) for f in members], "file_name string")
            rows = _parsed_records(header, lines.join(of_layout, "file_name", "left_semi"))
        parts.append(rows.select(*[_exact_text(c) for c in RAW_COLUMNS[table]], SOURCE_FILE))
    return reduce(DataFrame.unionByName, parts)


def _parsed_records(header: Sequence[str], lines: DataFrame) -> DataFrame:
    records = _joined_records(record_lines(lines)).filter(~F.col("is_header"))
    schema = ", ".join(f"`{name}` string" for name in header)
    row = F.from_csv("record", schema, {**CSV_OPTIONS, "multiLine": "true"})
    return records.select(row.alias("row"), F.col("file_name").alias(SOURCE_FILE)).select(
        "row.*", SOURCE_FILE
    )
