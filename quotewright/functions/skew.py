"""Joins from a large table to a set of keys that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.scratch import discard_at_exit, store

BROADCAST_ROWS = 200_000
SLICE_ROWS = 1_000_000
HOT_KEYS = 100_000


def join_counted_keys(
    rows: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    count: str,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The rows of ``rows`` whose key is in ``keys``.

    ``keys`` holds one row per key with the number of rows it has in
    ``count``. The keys are counted first: few are broadcast, so the large
    side is not shuffled at all. Many are joined by shuffle, and every key
    with more than a slice of rows is cut into slices. The hot keys needed
    for that number at most (rows / slice), which the slice size bounds.
    """
    on = list(on)
    keys = _stored(keys.select(*on, count))
    total = keys.agg(F.count("*").alias("keys"), F.sum(count).alias("rows")).first()
    if total["keys"] <= broadcast_rows:
        return rows.join(F.broadcast(keys.select(*on)), on, "left_semi")

    slice_rows = max(slice_rows, total["rows"] // HOT_KEYS)
    slices = F.ceil(F.col(count) / F.lit(slice_rows)).cast("int")
    keys = keys.withColumn("_slices", slices)
    hot = keys.filter(F.col("_slices") > 1).select(*on, "_slices")
    # The partition number spreads even identical rows, and a retried task
    # gives each of its rows the same slice again.
    placed = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_slice", F.coalesce(F.pmod(F.spark_partition_id(), F.col("_slices")), F.lit(0))
    )
    sliced = keys.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    joined = placed.join(
        sliced.select(*on, "_slice").hint("shuffle_merge"), [*on, "_slice"], "left_semi"
    )
    return joined.select(*rows.columns)


def join_distinct_keys(
    rows: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The rows of ``rows`` whose key is in ``keys``, which may repeat keys.

    Few distinct keys are broadcast. Otherwise the rows of each are counted,
    and only keys with more than a slice of rows are cut.
    """
    on = list(on)
    keys = keys.select(*on).distinct()
    if keys.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(keys), on, "left_semi")
    counted = rows.groupBy(*on).agg(F.count("*").alias("_count")).join(keys, on, "left_semi")
    return join_counted_keys(
        rows, counted, on, "_count", broadcast_rows=broadcast_rows, slice_rows=slice_rows
    )


def _stored(keys: DataFrame) -> DataFrame:
    """Keys written to the shared folder, so that they are counted once and held by no cache.

    The result is lazy and reads them as often as it is run, so they stay
    until the application ends.
    """
    spark = keys.sparkSession
    path = shared_dir(spark, "keys", uuid4().hex)
    stored = store(keys, path)
    discard_at_exit(spark, path)
    return stored
