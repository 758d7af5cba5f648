"""Session settings the library counts on, and its shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Times carry no zone in this data; a UTC session makes every cast a no-op.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MIB = 1024 * 1024
PARTITION_BYTES = 256 * MIB
# From here on a plan's size is a guess and not a measure.
UNKNOWN_BYTES = 2**60


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the library's session settings to a running session.

    Shuffles of windows and aggregations cannot be split at run time, only
    merged. So they start with a partition per core at least, and with one per
    256 MB if the size of the input is given; AQE merges what is small. Sizes
    the session has already are kept if none is given here.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
        -(-input_bytes // PARTITION_BYTES),
    )
    if input_bytes or spark.conf.get(INITIAL_PARTITIONS, None) is None:
        spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    return spark


def sized(rows: DataFrame) -> SparkSession:
    """Size the session's shuffles by the statistics of a frame's sources.

    A plan without a usable size leaves the session's sizes as they are.
    """
    plan = rows._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(size for size in sizes if size < UNKNOWN_BYTES)
    return configure(rows.sparkSession, known)


@contextmanager
def kept_sizes(spark: SparkSession) -> Iterator[None]:
    """Give the session its shuffle size back after a job that sized it for its own input."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="quotewright-")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, below ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder of the process;
    a cluster session without it is an error, since executors share no local
    disk. The session's own checkpoint folder is left as it is.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_dir()
    return "/".join([base.rstrip("/"), context.applicationId, *parts])
