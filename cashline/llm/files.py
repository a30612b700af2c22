"""Binary files that tasks write into the shared folder, and their manifest.

A task writes under a name of its own and returns the name as a row. Spark commits the rows of one
attempt per task, so the manifest (a Parquet table beside the files) names exactly the files that
count; what a lost or repeated attempt has left is never read.
"""

from __future__ import annotations

from uuid import uuid4

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def make(folder: str) -> None:
    """Create a folder for files, also where no task will write one."""
    system, path = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)


class NewFile:
    """A file in a folder of any file system that pyarrow knows by its URI."""

    def __init__(self, folder: str, suffix: str):
        make(folder)
        system, path = pyarrow.fs.FileSystem.from_uri(folder)
        self.name = f"{uuid4().hex}{suffix}"
        self.stream = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()


def uri(folder: str) -> str:
    """A folder as a URI; a plain path is one of the local file system."""
    return folder if "://" in folder or folder.startswith("file:/") else f"file://{folder}"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def contents(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """name and content of the files that the manifest names, read by Spark."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(f"{folder}/files")
    named = found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return named.join(manifest(spark, folder).select("name"), "name", "left_semi")
