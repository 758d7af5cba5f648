"""Health windows over a stream of run measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.operations import health_windows


def stream_health(
    measures: DataFrame,
    time: str,
    errors: Column,
    throttles: Column,
    duration_ms: Column,
    late_by: str = "10 minutes",
) -> DataFrame:
    """Health windows of a stream, for append mode.

    A window is given out, and its state dropped, once the watermark is past
    its end; rows later than that are left out. Watermarks need a timestamp
    with a zone, so times are cast on the way in and back.
    """
    zoned = measures.withColumn(time, F.col(time).cast("timestamp"))
    windows = health_windows(
        zoned.withWatermark(time, late_by), time, errors, throttles, duration_ms
    )
    ends = ("window_start", "window_end")
    return windows.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ends})
