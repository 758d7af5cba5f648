"""Time column helpers. All times are zone-less and mean UTC."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PARTITION_COLUMNS

# A time of day alone would be read as today's; a value must start with a year.
_HAS_YEAR = r"^\s*[+-]?\d{4}"


def parse_time(value: Column) -> Column:
    """Text to timestamp; NULL when it is none. Offsets are converted to UTC."""
    text = value.cast("string")
    return F.when(text.rlike(_HAS_YEAR), F.try_to_timestamp(text)).cast("timestamp_ntz")


def utc_literal(moment: datetime) -> Column:
    """A Python datetime as a zone-less UTC literal."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC)
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def whole_units(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units from start to end, cut toward zero."""
    return F.timestamp_diff(unit, start, end)


def date_parts(moment: Column) -> dict[str, Column]:
    """Zero-padded partition strings of a timestamp."""
    return {
        "year": F.date_format(moment, "yyyy"),
        "month": F.date_format(moment, "MM"),
        "day": F.date_format(moment, "dd"),
    }


def day_key() -> Column:
    """The day partition as text that orders by date, whatever its columns hold."""
    year, month, day = (F.col(name).cast("string") for name in PARTITION_COLUMNS)
    return F.concat(year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))


def run_parts(moment: Column, *, hourly: bool) -> dict[str, Column]:
    """Partition columns of an ingest run: date, maybe hour, and the run's id."""
    parts = date_parts(moment)
    if hourly:
        parts["hour"] = F.date_format(moment, "HH")
    parts["run_id"] = run_id(moment)
    return parts


def run_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")
