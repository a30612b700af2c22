"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.session import shared_folder

WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def settled(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written to the shared folder and read from there: lineage ends, lost executors cost nothing.

    The folder stays until the caller clears the shared folder, as the result may still be read.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_by_id(left: DataFrame, right: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """A join on the id in which null is an id; always by shuffle, as the ids grow with the corpus."""
    other = right.withColumnRenamed(key, "_other_id").hint("merge")
    return left.join(other, left[key].eqNullSafe(F.col("_other_id")), how).drop("_other_id")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of a Java character class. A null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{separators}+", -1), "")


def white_words(text: Column) -> Column:
    """Words between ASCII white space."""
    return split_words(text, r"[ \t\n\x0B\f\r]")
