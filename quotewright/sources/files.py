"""Scans and sinks of the zones, and symbol lists.

Sinks of a run replace that run's own partition and nothing else, so a job
that is run again after a failure leaves one copy of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import day_key, run_parts
from ..operators.standardize import symbol_universe
from ..schemas import (
    BRANCHES,
    BUSINESS_KEY,
    CURATED,
    DEFAULT_WATCHLIST,
    PARTITION_COLUMNS,
    QUOTE_COLUMNS,
    REJECTED,
    RUN_PARTITIONS,
    STANDARDIZED,
)

_RUN_ID = r"(\d{8}T\d{6}Z)"


def _file() -> Column:
    return F.col("_metadata.file_path")


def _between(rows: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Keep partitions of the given dates; the condition prunes the scan."""
    if first is not None:
        rows = rows.filter(day_key() >= f"{first:%Y%m%d}")
    if last is not None:
        rows = rows.filter(day_key() <= f"{last:%Y%m%d}")
    return rows


def scan_raw(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Raw response lines with their run and file."""
    lines = spark.read.text(path)
    return _between(lines, first, last).select(
        F.regexp_extract(_file(), _RUN_ID, 1).alias("run_id"),
        F.col("value").alias("response"),
        _file().alias("source_file"),
    )


def replayable(raw: DataFrame) -> DataFrame:
    """Raw lines as responses of their run again, for another ingest.

    The request is gone, so the position is NULL and the symbol the answer's.
    """
    run = F.try_to_timestamp("run_id", F.lit("yyyyMMdd'T'HHmmss'Z'"))
    return raw.select(
        run.cast("timestamp_ntz").alias("run_timestamp"),
        F.lit(None).cast("bigint").alias("position"),
        F.get_json_object("response", "$.symbol").alias("requested_symbol"),
        "response",
    )


def scan_standardized(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Standardized lines as text columns, with the file each came from."""
    rows = spark.read.schema(STANDARDIZED).json(path)
    if first is not None or last is not None:
        rows = _between(rows, first, last)
    return rows.select(*QUOTE_COLUMNS, _file().alias("source_file"))


def scan_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated table; partition columns are strings in any session."""
    return spark.read.schema(CURATED).parquet(path).select(*CURATED.names)


def scan_rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECTED).parquet(path).select(*REJECTED.names)


def scan_branch(spark: SparkSession, path: str, branch: str) -> DataFrame:
    """One branch of a split run; the other's files are not opened."""
    return spark.read.schema(BRANCHES).parquet(path).filter(F.col("branch") == branch)


def with_run_partitions(rows: DataFrame, *, hourly: bool) -> DataFrame:
    """Add the run's partition columns: date, hour if wanted, and run id."""
    return rows.withColumns(run_parts(F.col("run_timestamp"), hourly=hourly))


def _by_partition(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring partitions together so that a task writes few of them.

    AQE splits a large partition over several tasks and joins small ones, so
    neither a hot day nor a short one sets the size of a task.
    """
    return rows.hint("rebalance", *columns)


def write_raw(responses: DataFrame, path: str) -> None:
    """Append runs to the raw zone, by date and hour, one response a line.

    Line ends in a response become spaces. JSON has them between its parts
    only, never raw inside a string, so the value stays the same.
    """
    columns = [*PARTITION_COLUMNS, "hour", "run_id"]
    line = F.translate("response", "\r\n", "  ").alias("response")
    rows = with_run_partitions(responses, hourly=True).select(line, *columns)
    _by_partition(rows, columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*columns).text(path)


def write_standardized(quotes: DataFrame, path: str) -> None:
    """Append runs to the standardized zone, by date; nulls are written."""
    columns = [*PARTITION_COLUMNS, "run_id"]
    rows = with_run_partitions(quotes, hourly=False).select(*QUOTE_COLUMNS, *columns)
    _by_partition(rows, columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("ignoreNullFields", "false").partitionBy(*columns).json(path)


def _write_sorted(rows: DataFrame, path: str, mode: str, partitions: Sequence[str]) -> None:
    sorted_rows = rows.sortWithinPartitions(*partitions, *BUSINESS_KEY)
    sorted_rows.write.mode(mode).option("compression", "snappy").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partitions).parquet(path)


def write_curated(
    quotes: DataFrame,
    path: str,
    mode: str = "append",
    partitions: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Write curated quotes by market date, sorted by key within a file.

    Mode ``overwrite`` replaces the partitions the rows fall into, no others.
    """
    _write_sorted(_by_partition(quotes, PARTITION_COLUMNS), path, mode, partitions)


def write_branches(
    rows: DataFrame,
    path: str,
    partitions: Sequence[str] = PARTITION_COLUMNS,
    above: Sequence[str] = (),
) -> None:
    """Write both branches of a split run in one job, parted by ``branch`` and day.

    Partition columns ``above`` stand before these. Replaces the partitions the
    rows fall into, no others.
    """
    parted = [*above, "branch", *partitions]
    _write_sorted(_by_partition(rows, parted), path, "overwrite", parted)


def publish_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Write a run's rows, already laid out by day, as the run's own partitions of a table.

    The run again replaces what it wrote. Files are rewritten as they are read,
    without a shuffle.
    """
    _write_sorted(rows.withColumn("run_id", F.lit(run_id)), path, "overwrite", RUN_PARTITIONS)


def write_rejected(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write rejected rows by rejection date.

    They are few among many tasks' rows and of one date: spreading them evenly
    lets AQE choose how many files to write.
    """
    rows.hint("rebalance").write.mode(mode).option("compression", "snappy").partitionBy(
        *PARTITION_COLUMNS
    ).parquet(path)


def write_result(result: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a query result as CSV with a header."""
    result.write.mode(mode).option("header", True).csv(path)


def requested_symbols(spark: SparkSession, symbols: Sequence[str] | None = None) -> DataFrame:
    """The symbols of a request in order, or the default watchlist."""
    if symbols is None:
        symbols = DEFAULT_WATCHLIST
    elif not isinstance(symbols, (list, tuple)):
        raise ValueError("symbols must be a list")
    elif not any(str(s).strip() for s in symbols):
        raise ValueError("symbols must contain at least one symbol")
    rows = [(i, str(s)) for i, s in enumerate(symbols)]
    return symbol_universe(spark.createDataFrame(rows, "position bigint, symbol string"))
