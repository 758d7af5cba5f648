"""Rollups by day that reports over any dates are merged from, without reading quotes.

``daily_moments`` holds counts, means and squared deviations of each symbol and
day, ``daily_latest`` its newest quote, ``daily_tails`` its last prices. All keep
the partition columns of the quotes, so a day is worked out again alone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_form, rounded
from ..functions.times import day_key
from ..schemas import PARTITION_COLUMNS, QUOTE_COLUMNS
from . import analytics

MEASURES = ("price", "change_percent")

# Prices a day leaves behind: what means over seven observations look back to.
TAIL_ROWS = 6

c = F.col


def daily_moments(quotes: DataFrame) -> DataFrame:
    """Rows, extremes and moments of each symbol, company and day partition.

    Each measure has its number of values, mean and sum of squared deviations
    from it. The price also has the sum of its exact decimals and their number.
    """
    exact = exact_form(c("price"))
    moments = [
        column
        for name in MEASURES
        for column in (
            F.count(name).alias(f"{name}_count"),
            F.avg(name).alias(f"{name}_mean"),
            (F.var_pop(name) * F.count(name)).alias(f"{name}_squares"),
        )
    ]
    return quotes.groupBy(*PARTITION_COLUMNS, "symbol", "company_name").agg(
        F.count("*").alias("row_count"),
        F.min("price").alias("price_low"),
        F.max("price").alias("price_high"),
        F.count(exact).alias("exact_count"),
        F.sum(exact).alias("exact_sum"),
        *moments,
    )


def _combined(left: Column, right: Column) -> Column:
    """The moments of two sets of values together.

    The squared deviations grow by the distance of the means, so that nothing
    large is subtracted, however far the values lie from zero.
    """
    count = left["count"] + right["count"]
    apart = right["mean"] - left["mean"]
    share = right["count"] / count
    return F.struct(
        count.alias("count"),
        (left["mean"] + apart * share).alias("mean"),
        (left["squares"] + right["squares"] + apart * apart * left["count"] * share).alias(
            "squares"
        ),
    )


def merged_moments(name: str) -> Column:
    """Aggregate: the moments of a measure over the days of a group, in their order.

    A group's days are bounded by the calendar; each takes three numbers.
    """
    day = F.struct(
        *PARTITION_COLUMNS,
        c(f"{name}_count").alias("count"),
        c(f"{name}_mean").alias("mean"),
        c(f"{name}_squares").alias("squares"),
    )
    days = F.array_sort(F.collect_list(F.when(c(f"{name}_count") > 0, day)))
    none = F.struct(
        F.lit(0).cast("bigint").alias("count"),
        F.lit(0.0).alias("mean"),
        F.lit(0.0).alias("squares"),
    )
    return F.aggregate(days, none, _combined)


def _deviation(moments: Column) -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    spread = F.sqrt(moments["squares"] / (moments["count"] - 1))
    return F.when(moments["count"] > 1, spread)


def volatility_of(moments: DataFrame) -> DataFrame:
    """The volatility report of the days whose moments are given."""
    merged = moments.groupBy("symbol", "company_name").agg(
        F.sum("row_count").alias("observation_count"),
        F.min("price_low").alias("price_low"),
        F.max("price_high").alias("price_high"),
        F.sum("exact_count").alias("exact_count"),
        F.sum("exact_sum").alias("exact_sum"),
        merged_moments("price").alias("price"),
        merged_moments("change_percent").alias("change"),
    )
    count = c("price.count")
    exact = F.try_divide(c("exact_sum").cast("double"), count)
    mean = F.when(c("exact_count") == count, exact).otherwise(c("price.mean"))
    return (
        merged.filter(c("observation_count") > 1)
        .select(
            "symbol",
            "company_name",
            "observation_count",
            rounded(mean, 2).alias("average_price"),
            F.round("price_low", 2).alias("minimum_price"),
            F.round("price_high", 2).alias("maximum_price"),
            rounded(_deviation(c("price")), 2).alias("price_standard_deviation"),
            rounded(_deviation(c("change")), 2).alias("change_percent_standard_deviation"),
        )
        .orderBy(
            c("change_percent_standard_deviation").desc_nulls_last(), "symbol", "company_name"
        )
    )


def _newest_rows(rows: DataFrame) -> DataFrame:
    """The newest row of each symbol, market date and partition, with the latest ingest time."""
    kept = [n for n in QUOTE_COLUMNS if n != "symbol"]
    newest = F.max_by(F.struct(*kept), F.struct("market_timestamp", "ingestion_timestamp"))
    grouped = rows.groupBy("symbol", "market_date", *PARTITION_COLUMNS).agg(
        newest.alias("_newest"), F.max("latest_ingestion").alias("latest_ingestion")
    )
    columns = [c("symbol") if n == "symbol" else c(f"_newest.{n}") for n in QUOTE_COLUMNS]
    return grouped.select(*columns, "market_date", "latest_ingestion", *PARTITION_COLUMNS)


def daily_latest(quotes: DataFrame) -> DataFrame:
    """The newest quote of each symbol and market date, in each partition.

    All columns of a quote stay, so the reports on newest quotes work on this
    table as they do on quotes. ``latest_ingestion`` is that of all the rows.
    """
    return _newest_rows(
        quotes.withColumns(
            {
                "market_date": F.to_date("market_timestamp"),
                "latest_ingestion": c("ingestion_timestamp"),
            }
        )
    )


def merged_latest(older: DataFrame, newer: DataFrame) -> DataFrame:
    """One table of newest quotes from two, as of all rows behind both."""
    return _newest_rows(older.unionByName(newer))


def freshness_of(latest: DataFrame) -> DataFrame:
    """The freshness report from newest quotes."""
    return analytics.freshness(latest.withColumn("ingestion_timestamp", c("latest_ingestion")))


def _last_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """The last rows in time of each key; a task sends no more than these."""
    order = [c(n).desc_nulls_last() for n in ("market_timestamp", "ingestion_timestamp", "price")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter(c("_place") <= TAIL_ROWS).drop("_place")


def daily_tails(quotes: DataFrame) -> DataFrame:
    """The last prices of each symbol in each day partition."""
    columns = ("symbol", "market_timestamp", "ingestion_timestamp", "price")
    return _last_rows(quotes.select(*columns, *PARTITION_COLUMNS), "symbol", *PARTITION_COLUMNS)


def moving_avg_between(quotes: DataFrame, tails: DataFrame, first: date, last: date) -> DataFrame:
    """The seven-observation means of some days, as the whole table would give them.

    Of the days before ``first`` the tails are read and no quotes, however long
    a symbol had none. Quotes have to lie in the partition of their market date.
    """
    before = tails.filter(day_key() < f"{first:%Y%m%d}")
    return analytics.moving_avg_7(
        analytics.quotes_between(quotes, first, last), _last_rows(before, "symbol")
    )
