"""Session settings the jobs are written for."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Static settings of sessions we start ourselves. A cluster session keeps its own.
LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.sql.session.timeZone": "UTC",
}

# Runtime settings every job wants. AQE sizes the shuffle partitions from what was really
# written, turns a join into a broadcast only when the measured side is small, and splits the
# partitions that one hot key blew up.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows may be whole documents or pages: bounds what a batch for Python holds.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


SHUFFLE_BYTES = 64 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, *, partition_bytes: int = SHUFFLE_BYTES, most: int | None = None
) -> Iterator[None]:
    """Inside, shuffles start with enough partitions for this much input; never with fewer than set.

    Partitions that turn out small are coalesced by AQE afterwards, so only too few would hurt. There is
    no upper bound unless `most` names one. The session's own setting is back afterwards.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    wanted = -(-input_bytes // partition_bytes)
    wanted = wanted if most is None else min(wanted, most)
    if wanted > int(before or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, *, name: str = "cashline", shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and single-machine runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, default: str | None = None) -> str:
    """Folder all executors can reach: the cluster's `spark.checkpoint.dir`.

    Only where the cluster names none, the caller's default or (in local runs) a new temporary
    folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if default:
        return default
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="cashline-")


def work_folder(spark: SparkSession, owner: str) -> str:
    """A folder for the intermediate tables of one output folder, in the shared folder."""
    digest = hashlib.md5(owner.encode()).hexdigest()[:12]
    return f"{shared_folder(spark, owner)}/_work-{digest}"
