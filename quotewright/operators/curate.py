"""Standardized text rows to typed, checked and deduplicated quotes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import whole_text
from ..functions.plans import settle
from ..functions.text import normal_lower, normal_upper
from ..functions.times import date_parts, parse_time, utc_literal
from ..schemas import BRANCHES, BUSINESS_KEY, QUOTE_COLUMNS, REJECTED_BRANCH, VALID_BRANCH


def typed_quotes(standardized: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalize text and cast every column; a value that does not cast is NULL.

    The file a row came from is taken from a ``source_file`` column if there
    is one, else from the running scan. ``keep`` passes more columns through.
    """
    double = {
        name: F.col(name).try_cast("double")
        for name in (
            "price",
            "open_price",
            "high_price",
            "low_price",
            "previous_close",
            "change",
            "change_percent",
        )
    }
    columns = {
        "symbol": normal_upper(F.col("symbol")),
        "company_name": F.trim("company_name"),
        "exchange": normal_upper(F.col("exchange")),
        "currency": normal_upper(F.col("currency")),
        **double,
        "volume": whole_text(F.col("volume")),
        "market_timestamp": parse_time(F.col("market_timestamp")),
        "ingestion_timestamp": parse_time(F.col("ingestion_timestamp")),
        "source": normal_lower(F.col("source")),
    }
    if "source_file" not in standardized.columns:
        standardized = standardized.withColumn("source_file", F.input_file_name())
    return settle(standardized, columns, keep=["source_file", *keep])


def rejection_reason() -> Column:
    """The first rule a typed row breaks, or NULL."""
    # The reasons and their order.
    c = F.col
    return (
        F.when(c("symbol").isNull() | (F.length("symbol") == 0), "MISSING_SYMBOL")
        .when(c("price").isNull() | (c("price") <= 0), "INVALID_PRICE")
        .when(c("market_timestamp").isNull(), "INVALID_MARKET_TIMESTAMP")
        .when(c("ingestion_timestamp").isNull(), "INVALID_INGESTION_TIMESTAMP")
        .when(c("volume") < 0, "NEGATIVE_VOLUME")
        .when(c("high_price") < c("low_price"), "HIGH_BELOW_LOW")
    )


def assess(standardized: DataFrame) -> DataFrame:
    """Typed rows with their ``rejection_reason``."""
    return typed_quotes(standardized).withColumn("rejection_reason", rejection_reason())


def rejected_quotes(assessed: DataFrame, rejected_at: datetime) -> DataFrame:
    """The rejected rows, all of them, stamped with the run's time."""
    at = utc_literal(rejected_at)
    return assessed.filter(F.col("rejection_reason").isNotNull()).withColumns(
        {"rejected_at": at, **date_parts(at)}
    )


def valid_quotes(assessed: DataFrame) -> DataFrame:
    return assessed.filter(F.col("rejection_reason").isNull()).select(*QUOTE_COLUMNS)


def keep_latest(quotes: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """One row per symbol and market time: the one ingested last.

    Rows that differ in ``apart`` do not replace each other.

    Rows ingested at the same moment are told apart by the other columns, so
    the outcome does not depend on row order. Spark drops the losers before
    the shuffle (WindowGroupLimit), so one hot key costs one row per task.
    """
    rest = [n for n in QUOTE_COLUMNS if n not in (*BUSINESS_KEY, "ingestion_timestamp")]
    newest = Window.partitionBy(*BUSINESS_KEY, *apart).orderBy(
        *(F.col(n).desc_nulls_last() for n in ("ingestion_timestamp", *rest))
    )
    ranked = quotes.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def split_quotes(assessed: DataFrame, rejected_at: datetime) -> DataFrame:
    """Both outputs in one frame by ``branch``: the latest valid rows, all rejected rows.

    One window serves both, so the source is read once: a rejected row is a
    group of its own, which also deals rows without a key over all tasks.
    """
    rejected = F.col("rejection_reason").isNotNull()
    at = utc_literal(rejected_at)
    split = assessed.withColumns(
        {
            "branch": F.when(rejected, REJECTED_BRANCH).otherwise(VALID_BRANCH),
            "source_file": F.when(rejected, F.col("source_file")),
            "rejected_at": F.when(rejected, at),
            "_alone": F.when(rejected, F.monotonically_increasing_id()),
        }
    )
    day = F.when(rejected, at).otherwise(F.col("market_timestamp"))
    return keep_latest(split, ["_alone"]).withColumns(date_parts(day)).select(*BRANCHES.names)


def with_market_date(quotes: DataFrame) -> DataFrame:
    """Add year, month and day of the market time as partition strings."""
    return quotes.withColumns(date_parts(F.col("market_timestamp")))


def curated_quotes(standardized: DataFrame) -> DataFrame:
    """Standardized text rows to the curated table."""
    return with_market_date(keep_latest(valid_quotes(assess(standardized))))
