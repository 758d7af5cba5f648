"""Operating reports: missing runs, health windows, retention, rejections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import join_distinct_keys
from ..schemas import PARTITION_COLUMNS

# The run schedule and the alarm and retention limits.
EXCHANGE_ZONE = "America/New_York"
FIRST_SLOT_MINUTE = 9 * 60 + 30
LAST_SLOT_MINUTE = 16 * 60
SLOT_MINUTES = 5
HEALTH_MINUTES = 5
HEALTH_WINDOW = f"{HEALTH_MINUTES} minutes"
MAX_ERRORS = 1
MAX_THROTTLES = 1
MAX_DURATION_MS = 25_000
RETENTION_DAYS = {"raw": 90, "standardized": 365, "rejected": 90, "results": 30}

c = F.col


def expected_slots(spans: DataFrame, days: DataFrame) -> DataFrame:
    """All run slots (UTC) of each symbol on the weekdays of ``days`` in its span.

    ``spans`` has ``symbol``, ``first_date`` and ``last_date``, ``days`` distinct
    days. They meet by year, so a span of thousands of years is as many rows,
    and the days of the calendar bound what is broadcast. Slots are laid out in
    exchange time, so a change of the clock moves them.
    """
    years = F.sequence(F.year("first_date"), F.year("last_date"))
    by_year = days.filter(F.weekday("day") < 5).withColumn("_year", F.year("day"))
    inside = c("day").between(c("first_date"), c("last_date"))
    open_days = (
        spans.withColumn("_year", F.explode(years))
        .join(F.broadcast(by_year), "_year")
        .filter(inside)
        .select("symbol", "day")
        .hint("rebalance")
    )
    minutes = F.sequence(F.lit(FIRST_SLOT_MINUTE), F.lit(LAST_SLOT_MINUTE), F.lit(SLOT_MINUTES))
    local = c("day").cast("timestamp_ntz") + F.make_dt_interval(mins=c("minute"))
    utc = F.convert_timezone(F.lit(EXCHANGE_ZONE), F.lit("UTC"), local)
    return open_days.select("symbol", "day", F.explode(minutes).alias("minute")).select(
        "symbol", utc.alias("slot")
    )


def observed_slots(quotes: DataFrame) -> DataFrame:
    """The slots each symbol was ingested in."""
    slot = F.window("ingestion_timestamp", f"{SLOT_MINUTES} minutes")["start"]
    return quotes.select("symbol", slot.alias("slot")).distinct()


def missing_slots(
    quotes: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Expected slots of a symbol, between its first and last day, without a quote.

    With ``first`` and ``last`` every weekday between them is expected, else
    the weekdays on which any symbol was ingested.
    """
    day = F.to_date("ingestion_timestamp")
    dated = quotes.select("symbol", day.alias("day")).filter(c("day").isNotNull())
    if first is not None and last is not None:
        span = F.sequence(F.lit(first), F.lit(last))
        days = quotes.sparkSession.range(1).select(F.explode(span).alias("day"))
        dated = dated.filter(c("day").between(F.lit(first), F.lit(last)))
    else:
        days = dated.select("day").distinct()
    spans = dated.groupBy("symbol").agg(
        F.min("day").alias("first_date"), F.max("day").alias("last_date")
    )
    expected = expected_slots(spans, days)
    return expected.join(observed_slots(quotes), ["symbol", "slot"], "left_anti")


def window_measures(
    measures: DataFrame,
    time: str,
    errors: Column,
    throttles: Column,
    duration_ms: Column,
    *others: Column,
) -> DataFrame:
    """Errors, throttles and longest duration per five minutes, and other named aggregates.

    Rows without a time are in no window.
    """
    return (
        measures.groupBy(F.window(time, HEALTH_WINDOW).alias("_window"))
        .agg(
            F.sum(errors.cast("bigint")).alias("errors"),
            F.sum(throttles.cast("bigint")).alias("throttles"),
            F.max(duration_ms).alias("max_duration_ms"),
            *others,
        )
        .withColumns({"window_start": c("_window.start"), "window_end": c("_window.end")})
        .drop("_window")
    )


def merged_windows(parts: DataFrame) -> DataFrame:
    """One row per window from any number of parts of it."""
    return parts.groupBy("window_start", "window_end").agg(
        F.sum("errors").alias("errors"),
        F.sum("throttles").alias("throttles"),
        F.max("max_duration_ms").alias("max_duration_ms"),
    )


def with_alarms(windows: DataFrame) -> DataFrame:
    """Windows with an alarm for each measure; an unknown measure gives none."""
    limits = {
        "error_alarm": c("errors") >= MAX_ERRORS,
        "throttle_alarm": c("throttles") >= MAX_THROTTLES,
        "duration_alarm": c("max_duration_ms") >= MAX_DURATION_MS,
    }
    alarms = (F.coalesce(over, F.lit(False)).alias(name) for name, over in limits.items())
    return windows.select(
        "window_start", "window_end", "errors", "throttles", "max_duration_ms", *alarms
    )


def health_windows(
    measures: DataFrame, time: str, errors: Column, throttles: Column, duration_ms: Column
) -> DataFrame:
    """Errors, throttles and longest duration per five minutes, with alarms.

    Works on a batch and, with a watermark on ``time``, on a stream. A window
    without data has no row and so no alarm.
    """
    return with_alarms(window_measures(measures, time, errors, throttles, duration_ms))


def zone_partitions(rows: DataFrame, zone: str) -> DataFrame:
    """The day partitions of a zone's table."""
    days = rows.select(*PARTITION_COLUMNS).distinct()
    return days.select(F.lit(zone).alias("zone"), *PARTITION_COLUMNS)


def _is_expired(as_of: date) -> Column:
    limits = F.create_map(*(F.lit(x) for item in RETENTION_DAYS.items() for x in item))
    day = F.concat_ws("-", *PARTITION_COLUMNS).try_cast("date")
    # A zone without a limit, or a partition that is no date, never expires.
    oldest = F.date_sub(F.lit(as_of), F.try_element_at(limits, c("zone")))
    return F.coalesce(day < oldest, F.lit(False))


def expired_partitions(partitions: DataFrame, as_of: date) -> DataFrame:
    """Day partitions older than their zone keeps them."""
    return partitions.filter(_is_expired(as_of))


def kept_partitions(partitions: DataFrame, as_of: date) -> DataFrame:
    """Day partitions their zone still keeps."""
    return partitions.filter(~_is_expired(as_of))


def rejected_report(rejected: DataFrame) -> DataFrame:
    """Rejected rows by reason, rejection date and symbol."""
    day = F.to_date("rejected_at").alias("rejection_date")
    return (
        rejected.groupBy("rejection_reason", day, "symbol")
        .agg(F.count("*").alias("rejected_count"))
        .orderBy("rejection_reason", "rejection_date", F.col("symbol").asc_nulls_last())
    )


def restrict_to(quotes: DataFrame, universe: DataFrame) -> DataFrame:
    """The quotes whose symbol is in the universe."""
    return join_distinct_keys(quotes, universe, ["symbol"])
