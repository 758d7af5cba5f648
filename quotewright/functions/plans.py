"""Helpers that shape a query plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(rows: DataFrame, columns: dict[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``keep`` and costly columns, each worked out once per row.

    A filter on a plain column is pushed below it and carries a copy of its
    expression for every mention: casts would run twice, and rules stacked on
    parsed JSON would parse a row hundreds of times. Filters do not pass a
    generator, so the columns come out of one that yields a single row.
    """
    once = F.array(F.struct(*(column.alias(name) for name, column in columns.items())))
    return rows.select(*keep, F.inline(once))


def in_order(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Sort rows that may hold many with equal keys.

    A sort first samples its input for the bounds of its ranges, and so runs
    all that stands below it twice, back to the last shuffle. A shuffle just
    below the sort lets the sample read what the sort reads.

    A sort places rows by range, and equal rows cannot be parted. The number
    of the partition a row comes from, as a last key, lets them be.
    """
    placed = rows.hint("rebalance").withColumn("_from", F.spark_partition_id())
    return placed.orderBy(*keys, "_from").drop("_from")
