"""Incremental loading as a stream: new extract files load, known ones are skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cashline.session import work_folder
from cashline.sources.extracts import empty_extracts, named_extracts, table_folders
from cashline.sources.raw import load_files

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_extracts(
    spark: SparkSession, extracts_dir: str, raw_dir: str, *, checkpoint_dir: str | None = None
) -> StreamingQuery:
    """Load what is new in the extracts folder, as a query that stops when all is loaded.

    Each batch checks and appends its own files, and those alone: which files are new is the state that
    the stream keeps in its checkpoint. The load log still has the last word, so a batch replayed after a
    failure, or a stream that begins with a new checkpoint, adds nothing twice. A bad file fails the
    query, after the good ones are loaded, until it is repaired. Files of length zero, which are bad and
    which no batch names, are found by their length in the listing.
    """
    arrivals = (
        spark.readStream.schema(LISTING)
        .format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(table_folders(extracts_dir))
        .select("path")
    )

    def load_new(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        paths = batch.select("path").union(empty_extracts(session, extracts_dir))
        load_files(session, named_extracts(paths), raw_dir)

    return (
        arrivals.writeStream.foreachBatch(load_new)
        .option("checkpointLocation", checkpoint_dir or f"{work_folder(spark, raw_dir)}/stream")
        .trigger(availableNow=True)
        .start()
    )
