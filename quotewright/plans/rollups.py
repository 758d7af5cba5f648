"""Rollup tables beside a quotes table: refreshed by day, read by reports."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import check_states, rollups, symbol_sets
from ..schemas import CURATED, PARTITION_COLUMNS
from ..sources.scratch import discard

TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "moments": rollups.daily_moments,
    "latest": rollups.daily_latest,
    "tails": rollups.daily_tails,
    "check_states": check_states.check_states,
    "stray_keys": check_states.stray_keys,
}


def on_days(rows: DataFrame, days: Iterable[date]) -> DataFrame:
    """Rows in the partitions of some days; the others are not read."""
    texts = [day.isoformat() for day in days]
    return rows.filter(F.concat_ws("-", *PARTITION_COLUMNS).isin(texts))


def _replace_days(rows: DataFrame, folder: str, days: Collection[date] | None) -> None:
    """Write the rows of some days in place of what the folder holds of them, or of all days."""
    for day in days or ():
        parts = f"year={day:%Y}/month={day:%m}/day={day:%d}"
        discard(rows.sparkSession, f"{folder}/{parts}")
    writer = rows.hint("rebalance", *PARTITION_COLUMNS).write
    writer = writer.option("partitionOverwriteMode", "static")
    writer.mode("overwrite" if days is None else "append").partitionBy(
        *PARTITION_COLUMNS
    ).parquet(folder)


def refresh(
    quotes: DataFrame,
    path: str,
    days: Collection[date] | None = None,
    names: Iterable[str] = tuple(TABLES),
) -> None:
    """Work out rollups of the touched days of ``quotes`` again, or of all of them.

    A touched day's folders go first, so that a day without rows leaves none,
    and a run that broke off is repaired by running it again. Partitions that
    are no date change with a refresh of all days only.
    """
    touched = quotes if days is None else on_days(quotes, days)
    for name in names:
        _replace_days(TABLES[name](touched), f"{path}/{name}", days)


def scan_rollup(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A rollup as its function gives it; partition columns are strings."""
    columns = TABLES[name](spark.createDataFrame([], CURATED)).schema
    return spark.read.schema(columns).parquet(f"{path}/{name}").select(*columns.names)


def scan_numbers(spark: SparkSession, path: str) -> DataFrame:
    """The numbers given to symbols; none before the first refresh."""
    folder = f"{path}/symbol_numbers"
    none = spark.createDataFrame([], symbol_sets.NUMBERS)
    none.write.mode("ignore").parquet(folder)
    return spark.read.schema(none.schema).parquet(folder)


def refresh_symbol_sets(
    quotes: DataFrame, path: str, days: Collection[date] | None = None
) -> None:
    """Work out the symbol sets of the touched days again, or of all of them.

    New symbols get their numbers first. A run that broke off in between leaves
    numbers that the next one keeps, and gaps at worst. Numbers are never taken
    back, so sets of other days stay right. One run at a time may refresh.
    """
    spark = quotes.sparkSession
    touched = quotes if days is None else on_days(quotes, days)
    new = symbol_sets.new_numbers(scan_numbers(spark, path), touched)
    new.write.mode("append").parquet(f"{path}/symbol_numbers")
    sets = symbol_sets.daily_sets(touched, scan_numbers(spark, path))
    _replace_days(sets, f"{path}/symbol_sets", days)


def scan_symbol_sets(spark: SparkSession, path: str) -> DataFrame:
    none = spark.createDataFrame([], CURATED), spark.createDataFrame([], symbol_sets.NUMBERS)
    columns = symbol_sets.daily_sets(*none).schema
    return spark.read.schema(columns).parquet(f"{path}/symbol_sets").select(*columns.names)
