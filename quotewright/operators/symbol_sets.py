"""Symbols of each day and exchange as bitmaps, so that distinct counts merge.

A dictionary gives every symbol a number that it keeps. ``daily_sets`` holds the
numbers found on a day at an exchange as bitmaps, beside sums that add up;
counts over any days come from their union, and no symbol is shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_form, rounded
from ..schemas import PARTITION_COLUMNS

NUMBERS = "symbol string, number bigint"
MEASURES = ("price", "change_percent")

# Shares that new symbols are numbered in; their counts are what one task adds up.
SHARES = 4096

c = F.col


def new_numbers(known: DataFrame, quotes: DataFrame) -> DataFrame:
    """Numbers for the symbols of ``quotes`` that ``known`` has none for.

    They follow the largest one given and have no gaps. Each share of the
    symbols is numbered in its own task, from the count of the shares before,
    so the same rows always give the same numbers. A NULL symbol has none.
    """
    largest = known.agg(F.max("number")).first()[0] or 0
    symbols = quotes.select("symbol").filter(c("symbol").isNotNull()).distinct()
    share = F.pmod(F.xxhash64("symbol"), F.lit(SHARES))
    new = symbols.join(known, "symbol", "left_anti").withColumn("_share", share)
    before = Window.orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        new.groupBy("_share")
        .agg(F.count("*").alias("_count"))
        .select("_share", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy("_share").orderBy("symbol"))
    return (
        new.withColumn("_place", place)
        .join(F.broadcast(starts), "_share")
        .select("symbol", (c("_start") + c("_place") + largest).cast("bigint").alias("number"))
    )


def _sums() -> list:
    sums = [F.sum("row_count").alias("row_count"), F.sum("volume").alias("volume")]
    for name in MEASURES:
        parts = (f"{name}_count", f"{name}_sum", f"{name}_exact_count", f"{name}_exact_sum")
        sums += [F.sum(part).alias(part) for part in parts]
    return [*sums, F.min("earliest").alias("earliest"), F.max("latest").alias("latest")]


def daily_sets(quotes: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of symbols and sums, for each day partition, exchange and block of numbers.

    Quotes are added up by symbol first, in part before the shuffle, so a
    symbol with many of them meets its number in few rows: one a day and
    exchange. Rows without a symbol are in a block of their own. A symbol
    without a number is an error and not left out of the counts.
    """
    exact = {name: exact_form(c(name)) for name in MEASURES}
    measures = [
        column
        for name in MEASURES
        for column in (
            F.count(name).alias(f"{name}_count"),
            F.sum(name).alias(f"{name}_sum"),
            F.count(exact[name]).alias(f"{name}_exact_count"),
            F.sum(exact[name]).alias(f"{name}_exact_sum"),
        )
    ]
    by_symbol = quotes.groupBy(*PARTITION_COLUMNS, "exchange", "symbol").agg(
        F.count("*").alias("row_count"),
        F.sum("volume").alias("volume"),
        *measures,
        F.min("market_timestamp").alias("earliest"),
        F.max("market_timestamp").alias("latest"),
    )
    unknown = F.raise_error(F.concat(F.lit("symbol without a number: "), c("symbol")))
    number = F.coalesce(c("number"), F.when(c("symbol").isNotNull(), unknown.cast("bigint")))
    numbered = by_symbol.join(numbers, "symbol", "left").withColumn("number", number)
    return numbered.groupBy(
        *PARTITION_COLUMNS, "exchange", F.bitmap_bucket_number("number").alias("block")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("symbols"), *_sums())


def _united(sets: DataFrame, *keys: str) -> DataFrame:
    """Sums and the number of different symbols for each key: a union for each block, then counts."""
    blocks = sets.groupBy(*keys, "block").agg(
        F.bitmap_count(F.bitmap_or_agg("symbols")).alias("symbol_count"), *_sums()
    )
    return blocks.groupBy(*keys).agg(F.sum("symbol_count").alias("symbol_count"), *_sums())


def _mean(name: str):
    """The mean of a measure: of its exact decimals if all values have one."""
    count = c(f"{name}_count")
    exact = F.try_divide(c(f"{name}_exact_sum").cast("double"), count)
    plain = F.try_divide(c(f"{name}_sum"), count)
    return F.when(c(f"{name}_exact_count") == count, exact).otherwise(plain)


def exchange_summary_of(sets: DataFrame) -> DataFrame:
    """The exchange summary of the days whose sets are given."""
    return (
        _united(sets, "exchange")
        .select(
            "exchange",
            "symbol_count",
            c("row_count").alias("quote_count"),
            rounded(_mean("price"), 2).alias("average_stock_price"),
            rounded(_mean("change_percent"), 2).alias("average_change_percent"),
            c("volume").alias("total_reported_volume"),
        )
        .orderBy(c("total_reported_volume").desc_nulls_last(), "exchange")
    )


def partition_summary_of(sets: DataFrame, symbols: str = "symbol_count") -> DataFrame:
    """Rows, symbols and time range of each day partition, newest first."""
    return (
        _united(sets, *PARTITION_COLUMNS)
        .select(
            *PARTITION_COLUMNS,
            "row_count",
            c("symbol_count").alias(symbols),
            c("earliest").alias("earliest_market_timestamp"),
            c("latest").alias("latest_market_timestamp"),
        )
        .orderBy(*(c(n).desc_nulls_last() for n in PARTITION_COLUMNS))
    )

