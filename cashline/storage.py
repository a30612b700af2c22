"""Folders on whatever file system the session's paths name."""

from __future__ import annotations

import os
import re
import time
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# How tables are stored: hashed keys are hex digits, of which zstd needs half the bytes and Spark's default all.
STORED = {"compression": "zstd"}

_PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


def _file_system(spark: SparkSession, path: str):
    # PySpark shows no file system of its own; Spark Connect sessions have no JVM to ask.
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, with all it holds; no folder is no error."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder, none where there is none."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return []
    return [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as it stands in the name of its folder."""
    if _PLAIN.fullmatch(value):
        return value
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def empty_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files of length zero that match a pattern; scans pass over these."""
    files, where = _file_system(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(where) or [] if s.isFile() and s.getLen() == 0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, such as an extract that has a header only."""
    files, where = _file_system(spark, path)
    out = files.create(where)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move all files of a folder into another one."""
    files, where = _file_system(spark, source)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(path(target))
    for status in files.listStatus(where):
        files.rename(status.getPath(), path(f"{target}/{status.getPath().getName()}"))


def append_rows(spark: SparkSession, rows: DataFrame, folder: str) -> None:
    """Add a few rows to a Parquet folder as one file, which is written aside and then renamed into it.

    Two writers may do so at once; Spark's own append would have them share a temporary folder, which
    the first one to finish deletes.
    """
    aside = f"{folder}-{uuid4().hex}"
    rows.coalesce(1).write.parquet(aside)
    files, where = _file_system(spark, aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files.mkdirs(path(folder))
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("part-") and not files.rename(status.getPath(), path(f"{folder}/{name}")):
            raise OSError(f"cannot move {status.getPath()} into {folder}")
    files.delete(where, True)


def create_new(spark: SparkSession, path: str) -> bool:
    """Make an empty file, or say that there is one already. Of several that try at once, one makes it."""
    files, where = _file_system(spark, path)
    if files.getUri().getScheme() == "file":  # Hadoop looks first and creates then, so several would make it
        local = files.makeQualified(where).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o666))
        except FileExistsError:
            return False
        return True
    try:
        files.create(where, False).close()
    except Py4JJavaError as error:
        if not files.exists(where):
            raise OSError(str(error.java_exception)) from error
        return False
    return True


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def ages(spark: SparkSession, folder: str) -> dict[str, float]:
    """Seconds since each file directly in a folder was written, by name."""
    files, where = _file_system(spark, folder)
    if not files.exists(where):
        return {}
    now = time.time()
    return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in files.listStatus(where) if s.isFile()}
