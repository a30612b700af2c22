"""Tables whose rows lie in Spark's hash buckets of a document number.

Headers, items and facts of documents meet on the document number again and again. Stored in buckets of
it they lie where these joins want them, so Spark leaves the shuffles out. A document has few rows, so no
bucket is hot; keys that can hold a third of all rows, such as customers, are not stored like this.

Spark knows the buckets of a file through a table of its catalog only. Such a table is named for the
moment in which it is read and forgotten at once: frames keep what they know of their files.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashline.storage import STORED


@contextmanager
def _named_table(spark: SparkSession):
    name = f"placed_{uuid4().hex}"
    try:
        yield name
    finally:
        # The files are outside of the catalog, so they stay.
        spark.sql(f"drop table if exists `{name}`")


def in_buckets(df: DataFrame, n_buckets: int, key: str) -> DataFrame:
    """`df` with one partition per bucket of `key`; without a shuffle where its rows lie so already."""
    return df.repartition(n_buckets, key)


def write_placed(df: DataFrame, path: str, key: str, n_buckets: int) -> DataFrame:
    """Write a table in buckets of `key`, one file each, and read it. The folder is plain Parquet as well."""
    spark = df.sparkSession
    with _named_table(spark) as name:
        placed = in_buckets(df, n_buckets, key).write.format("parquet").options(path=path, **STORED)
        placed.bucketBy(n_buckets, key).sortBy(key).saveAsTable(name)
        return spark.table(name)


def read_placed(spark: SparkSession, path: str, schema: T.StructType, key: str, n_buckets: int) -> DataFrame:
    """Read what `write_placed` has written, in any session, with the buckets it has."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    with _named_table(spark) as name:
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table `{name}` ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
            f"into {n_buckets} buckets location '{location}'"
        )
        return spark.table(name)


def placed_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str, n_buckets: int, *, spread: bool = False
) -> DataFrame:
    """Join on `on` (left column, right column) by buckets of the first pair; a side that lies so is not moved.

    Rows that agree in the first pair are compared in the others one by one, as Spark would move both sides
    to join on more columns than they are stored by. That is for keys of few rows, as those of a document.

    Say `spread` where the left column may be NULL in many rows. They find nothing, so they need not meet:
    each goes to a bucket by the hash of the whole row. The column must be text.
    """
    (key, reference), *more = on
    place = "__place" if spread else key
    if spread:
        nowhere = F.concat(F.lit("\0"), F.xxhash64(*left.columns).cast("string"))
        left = left.withColumn(place, F.coalesce(F.col(key), nowhere))
    left, right = in_buckets(left, n_buckets, place), in_buckets(right, n_buckets, reference)
    equal = [left[place] == right[reference]]
    equal += [(left[a] <= right[b]) & (left[a] >= right[b]) for a, b in more]  # equality that is no join key
    if spread:
        equal.append(left[key].isNotNull())
    joined = left.join(right, equal, how)
    return joined.drop(place) if spread else joined
