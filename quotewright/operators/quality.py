"""Quality checks over the curated table: each returns the rows that fail.

Every check works on any quotes table with partition columns, so it can be run
before curation as well as on the curated table, where most find nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import above, below, rounded
from ..functions.plans import in_order
from ..functions.skew import join_counted_keys
from ..functions.text import normal_lower, normal_upper
from ..functions.times import date_parts, whole_units
from ..schemas import BUSINESS_KEY, PARTITION_COLUMNS, QUOTE_COLUMNS
from .analytics import partition_summary

# Tolerances and partition formats of the checks.
CHANGE_TOLERANCE = 0.02
PERCENT_TOLERANCE = 0.05
MAX_DELAY_HOURS = 24
PARTITION_FORMATS = {
    "year": r"^[0-9]{4}$",
    "month": r"^(0[1-9]|1[0-2])$",
    "day": r"^(0[1-9]|[12][0-9]|3[01])$",
}

c = F.col


def _any(*conditions: Column) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


# --- conditions ---------------------------------------------------------------


def _blank_symbol() -> Column:
    return c("symbol").isNull() | (F.trim("symbol") == "")


def _required_missing() -> Column:
    others = (c(n).isNull() for n in ("price", "market_timestamp", "ingestion_timestamp"))
    return _any(_blank_symbol(), *others)


def _high_below_low() -> Column:
    return below(c("high_price"), c("low_price"))


def _price_out_of_range() -> Column:
    known = c("high_price").isNotNull() & c("low_price").isNotNull()
    return known & (above(c("price"), c("high_price")) | below(c("price"), c("low_price")))


def _not_upper(name: str) -> Column:
    return c(name) != normal_upper(c(name))


def _market_ahead() -> Column:
    return c("market_timestamp") > c("ingestion_timestamp")


def _delay_hours() -> Column:
    return whole_units("HOUR", c("market_timestamp"), c("ingestion_timestamp"))


def wrong_partition() -> Column:
    expected = date_parts(c("market_timestamp"))
    return _any(*(c(n) != expected[n] for n in PARTITION_COLUMNS))


def _bad_partition_format() -> Column:
    return _any(
        *(c(n).isNull() | ~c(n).rlike(p) for n, p in PARTITION_FORMATS.items())
    )


def _change_gap() -> Column:
    return F.abs(c("change") - (c("price") - c("previous_close")))


def _calculated_percent() -> Column:
    return F.try_divide(c("change"), c("previous_close")) * 100


def _percent_gap() -> Column:
    return F.abs(c("change_percent") - _calculated_percent())


def _broken_ohlc() -> Column:
    return _any(
        below(c("high_price"), c("open_price")),
        below(c("high_price"), c("price")),
        above(c("low_price"), c("open_price")),
        above(c("low_price"), c("price")),
    )


# --- one function per check ---------------------------------------------------


def required(quotes: DataFrame) -> DataFrame:
    """A required column is NULL, or the symbol blank."""
    return quotes.filter(_required_missing()).select(
        "symbol", "price", "market_timestamp", "ingestion_timestamp"
    )


def price(quotes: DataFrame) -> DataFrame:
    """Price not above zero."""
    return quotes.filter(c("price") <= 0).select("symbol", "price", "market_timestamp")


def volume(quotes: DataFrame) -> DataFrame:
    """Negative volume; no volume is fine."""
    return quotes.filter(c("volume") < 0).select("symbol", "volume", "market_timestamp")


def high_low(quotes: DataFrame) -> DataFrame:
    """High below low."""
    return quotes.filter(_high_below_low()).select(
        "symbol", "high_price", "low_price", "market_timestamp"
    )


def price_in_range(quotes: DataFrame) -> DataFrame:
    """Price outside low to high."""
    return quotes.filter(_price_out_of_range()).select(
        "symbol", "price", "high_price", "low_price", "market_timestamp"
    )


def duplicate_keys(quotes: DataFrame) -> DataFrame:
    """Business keys held by more than one row."""
    counted = quotes.groupBy(*BUSINESS_KEY).agg(F.count("*").alias("duplicate_count"))
    return counted.filter(c("duplicate_count") > 1)


def duplicate_rows(quotes: DataFrame, **limits: int) -> DataFrame:
    """All rows of the business keys held by more than one row."""
    keys = duplicate_keys(quotes).dropna(subset=list(BUSINESS_KEY))
    found = join_counted_keys(quotes, keys, BUSINESS_KEY, "duplicate_count", **limits)
    rows = found.select(*QUOTE_COLUMNS, *PARTITION_COLUMNS)
    return in_order(rows, *BUSINESS_KEY, "ingestion_timestamp")


def symbol_normalized(quotes: DataFrame) -> DataFrame:
    """Symbol not trimmed or not upper case."""
    return quotes.filter(_not_upper("symbol")).select("symbol", "market_timestamp")


def exchange_normalized(quotes: DataFrame) -> DataFrame:
    """Exchange not trimmed or not upper case."""
    return quotes.filter(_not_upper("exchange")).select(
        "symbol", "exchange", "market_timestamp"
    )


def currency_normalized(quotes: DataFrame) -> DataFrame:
    """Currency not trimmed or not upper case."""
    return quotes.filter(_not_upper("currency")).select(
        "symbol", "currency", "market_timestamp"
    )


def source_normalized(quotes: DataFrame) -> DataFrame:
    """Source not trimmed or not lower case."""
    return quotes.filter(c("source") != normal_lower(c("source"))).select(
        "symbol", "source", "market_timestamp"
    )


def market_ahead(quotes: DataFrame) -> DataFrame:
    """Market time after ingest time, with the whole minutes between."""
    ahead = whole_units("MINUTE", c("ingestion_timestamp"), c("market_timestamp"))
    return quotes.filter(_market_ahead()).select(
        "symbol",
        "market_timestamp",
        "ingestion_timestamp",
        ahead.alias("market_ahead_minutes"),
    )


def ingest_delay(quotes: DataFrame) -> DataFrame:
    """Ingested more than 24 whole hours after market time, longest first."""
    late = quotes.filter(_delay_hours() > MAX_DELAY_HOURS).select(
        "symbol",
        "market_timestamp",
        "ingestion_timestamp",
        _delay_hours().alias("ingestion_delay_hours"),
    )
    return in_order(
        late, F.desc("ingestion_delay_hours"), *BUSINESS_KEY, "ingestion_timestamp"
    )


def partition_match(quotes: DataFrame) -> DataFrame:
    """Partition strings other than the market date."""
    return quotes.filter(wrong_partition()).select(
        "symbol", "market_timestamp", *PARTITION_COLUMNS
    )


def partition_format(quotes: DataFrame) -> DataFrame:
    """Partition strings missing or not zero-padded date parts."""
    return quotes.filter(_bad_partition_format()).select(
        "symbol", *PARTITION_COLUMNS, "market_timestamp"
    )


def change_consistent(quotes: DataFrame) -> DataFrame:
    """Change other than price minus previous close, beyond rounding."""
    return quotes.filter(above(_change_gap(), F.lit(CHANGE_TOLERANCE))).select(
        "symbol",
        "price",
        "previous_close",
        "change",
        (c("price") - c("previous_close")).alias("calculated_change"),
        _change_gap().alias("difference"),
        "market_timestamp",
    )


def percent_consistent(quotes: DataFrame) -> DataFrame:
    """Percent change other than change over previous close, beyond rounding."""
    return quotes.filter(above(_percent_gap(), F.lit(PERCENT_TOLERANCE))).select(
        "symbol",
        "previous_close",
        "change",
        "change_percent",
        rounded(_calculated_percent(), 4).alias("calculated_change_percent"),
        _percent_gap().alias("difference"),
        "market_timestamp",
    )


def ohlc(quotes: DataFrame) -> DataFrame:
    """High below open or price, or low above open or price."""
    return quotes.filter(_broken_ohlc()).select(
        "symbol", "open_price", "high_price", "low_price", "price", "market_timestamp"
    )


def partition_counts(quotes: DataFrame) -> DataFrame:
    """Rows, symbols and time range per day partition."""
    return partition_summary(quotes, symbols="distinct_symbol_count")


def symbol_counts(quotes: DataFrame) -> DataFrame:
    """Rows and time range per symbol and company, most rows first."""
    return (
        quotes.groupBy("symbol", "company_name")
        .agg(
            F.count("*").alias("record_count"),
            F.min("market_timestamp").alias("earliest_market_timestamp"),
            F.max("market_timestamp").alias("latest_market_timestamp"),
        )
        .orderBy(F.desc("record_count"), "symbol", "company_name")
    )


def failures(condition: Column) -> Column:
    """Rows meeting a condition; NULL over an empty table, as a plain sum is."""
    return F.sum(F.when(condition, 1).otherwise(0))


def null_profile(quotes: DataFrame) -> DataFrame:
    """One row: all rows, and the NULLs of every column."""
    nulls = (failures(c(n).isNull()).alias(f"{n}_nulls") for n in QUOTE_COLUMNS)
    return quotes.agg(F.count("*").alias("total_rows"), *nulls)


def scorecard_checks() -> dict[str, Column]:
    return {
        "invalid_symbol_rows": _blank_symbol(),
        "invalid_price_rows": c("price").isNull() | (c("price") <= 0),
        "invalid_market_timestamp_rows": c("market_timestamp").isNull(),
        "invalid_ingestion_timestamp_rows": c("ingestion_timestamp").isNull(),
        "negative_volume_rows": c("volume") < 0,
        "invalid_high_low_rows": _high_below_low(),
        "future_market_timestamp_rows": _market_ahead(),
        "partition_mismatch_rows": wrong_partition(),
    }


def scorecard(quotes: DataFrame) -> DataFrame:
    """One row: all rows, and the rows failing each of the main checks."""
    counts = (failures(condition).alias(name) for name, condition in scorecard_checks().items())
    return quotes.agg(F.count("*").alias("total_rows"), *counts)


# --- all checks in one pass ---------------------------------------------------

NO_ROWS, ROUNDING, REVIEW = "no_rows", "no_rows_but_rounding", "review"


def row_checks() -> dict[str, tuple[Column, str]]:
    return {
        "dq_required": (_required_missing(), NO_ROWS),
        "dq_price": (c("price") <= 0, NO_ROWS),
        "dq_volume": (c("volume") < 0, NO_ROWS),
        "dq_high_low": (_high_below_low(), NO_ROWS),
        "dq_price_range": (_price_out_of_range(), NO_ROWS),
        "dq_symbol_norm": (_not_upper("symbol"), NO_ROWS),
        "dq_exchange_norm": (_not_upper("exchange"), NO_ROWS),
        "dq_currency_norm": (_not_upper("currency"), NO_ROWS),
        "dq_source_norm": (c("source") != normal_lower(c("source")), NO_ROWS),
        "dq_future": (_market_ahead(), NO_ROWS),
        "dq_delay": (_delay_hours() > MAX_DELAY_HOURS, REVIEW),
        "dq_partition_match": (wrong_partition(), NO_ROWS),
        "dq_partition_format": (_bad_partition_format(), NO_ROWS),
        "dq_change": (above(_change_gap(), F.lit(CHANGE_TOLERANCE)), ROUNDING),
        "dq_change_pct": (above(_percent_gap(), F.lit(PERCENT_TOLERANCE)), ROUNDING),
        "dq_ohlc": (_broken_ohlc(), NO_ROWS),
    }


def long_form(totals: DataFrame, expectations: dict[str, str]) -> DataFrame:
    entries = (
        F.struct(
            F.lit(name).alias("check"),
            c(name).alias("failures"),
            F.lit(expectation).alias("expectation"),
            (c(name) == 0).alias("passed"),
        )
        for name, expectation in expectations.items()
    )
    return totals.select(F.inline(F.array(*entries)))


def report(quotes: DataFrame) -> DataFrame:
    """Check, failures, expectation and outcome, a row per check.

    All row checks share one scan and one aggregation; the two duplicate
    checks need the rows counted by key and share another.
    """
    checks = row_checks()
    rows = quotes.agg(*(F.count_if(cond).alias(n) for n, (cond, _) in checks.items()))
    keys = duplicate_keys(quotes)
    whole = _any(*(c(n).isNull() for n in BUSINESS_KEY))
    duplicates = keys.agg(
        F.count("*").alias("dq_dup_keys"),
        F.coalesce(F.sum(F.when(~whole, c("duplicate_count"))), F.lit(0)).alias("dq_dup_rows"),
    )
    return long_form(rows, {n: e for n, (_, e) in checks.items()}).unionByName(
        long_form(duplicates, {"dq_dup_keys": NO_ROWS, "dq_dup_rows": NO_ROWS})
    )
