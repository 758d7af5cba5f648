"""Health windows of a stream that keep the rows which come too late for theirs.

A watermark inside a streaming aggregation drops late rows unseen. Here each
batch takes the watermark that the batch before it left, so it is known which
rows are late: those whose window has been given out. They go to a table of
their own. Everything a batch writes lies in folders of its number and follows
from its rows and the state before it, so a batch that is run again after a
failure leaves the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import utc_literal
from ..operators.operations import HEALTH_MINUTES, merged_windows, window_measures, with_alarms
from ..sources.scratch import discard, store

LATE_BY = timedelta(minutes=10)
BATCH = "arrived_in"

# Tables below the base folder. Windows are open or closed as of their batch; the clock
# holds the newest time seen, and is written last.
WINDOWS, LATE, CLOCK = "windows", "late", "clock"
_WINDOW_COLUMNS = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("errors", T.LongType()),
        T.StructField("throttles", T.LongType()),
        T.StructField("max_duration_ms", T.DoubleType()),
    ]
)
_PLACED = T.StructType(
    [
        *_WINDOW_COLUMNS.fields,
        T.StructField(BATCH, T.LongType()),
        T.StructField("closed", T.BooleanType()),
    ]
)
_NEWEST = T.StructType([T.StructField("newest", T.TimestampNTZType()), T.StructField(BATCH, T.LongType())])

c = F.col


@dataclass(frozen=True)
class Measures:
    """The column of a row's time, and what it adds to its window, as expressions."""

    time: str
    errors: str
    throttles: str
    duration_ms: str

    def windows(self, rows: DataFrame) -> DataFrame:
        """Windows of rows, each with the newest time in it."""
        errors, throttles = F.expr(self.errors), F.expr(self.throttles)
        duration = F.expr(self.duration_ms).cast("double")
        newest = F.max(self.time).alias("newest")
        return window_measures(rows, self.time, errors, throttles, duration, newest)


def _at(base: str, table: str, batch: int) -> str:
    return f"{base}/{table}/{BATCH}={batch}"


def _clock(spark: SparkSession, base: str, before: int | None = None) -> tuple[int, datetime | None] | None:
    """The last finished batch, of those before a number, and the newest time seen by then."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{CLOCK}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    clocks = spark.read.schema(_NEWEST).parquet(f"{base}/{CLOCK}")
    if before is not None:
        clocks = clocks.filter(c(BATCH) < before)
    last = clocks.orderBy(F.desc(BATCH)).first()
    return (last[BATCH], last["newest"]) if last else None


def _watermark(newest: datetime | None, late_by: timedelta) -> Column:
    """The end of the last window that is over, after which rows are in time."""
    if newest is None:
        return F.lit(None).cast("timestamp_ntz")
    past = newest - late_by - datetime(1970, 1, 1)
    return utc_literal(newest - late_by - past % timedelta(minutes=HEALTH_MINUTES))


def _is_late(time: str, watermark: Column) -> Column:
    """The row's window is over; a row without a time has none, and is late for any."""
    return c(time).isNull() | F.coalesce(c(time) < watermark, F.lit(False))


def take_batch(
    rows: DataFrame, batch: int, base: str, measures: Measures, late_by: timedelta = LATE_BY
) -> None:
    """Bring one batch into the windows, and its late rows into theirs.

    The open windows, all that is read of earlier batches, are bounded by the
    time rows may be late.
    """
    spark = rows.sparkSession
    last = _clock(spark, base, before=batch)
    number, newest = last or (None, None)
    late = _is_late(measures.time, _watermark(newest, late_by))
    rows.filter(late).write.mode("overwrite").parquet(_at(base, LATE, batch))

    parts = f"{base}/parts"
    discard(spark, parts)
    on_time = rows.filter(~late)
    found = store(measures.windows(on_time), parts)
    seen = found.agg(F.max("newest")).first()[0]
    newest = max((moment for moment in (newest, seen) if moment is not None), default=None)

    merged = found.select(*_WINDOW_COLUMNS.names)
    if number is not None:
        placed = spark.read.schema(_PLACED).parquet(f"{base}/{WINDOWS}")
        before = placed.filter((c(BATCH) == number) & ~c("closed"))
        merged = merged.unionByName(before.select(*_WINDOW_COLUMNS.names))
    closed = F.coalesce(c("window_end") <= _watermark(newest, late_by), F.lit(False))
    merged_windows(merged).withColumn("closed", closed).write.mode("overwrite").partitionBy(
        "closed"
    ).parquet(_at(base, WINDOWS, batch))

    clock = spark.range(1).select(
        (utc_literal(newest) if newest is not None else F.lit(None).cast("timestamp_ntz")).alias("newest")
    )
    clock.write.mode("overwrite").parquet(_at(base, CLOCK, batch))
    discard(spark, parts)
    if number is not None:
        # A batch run again begins with the state of the one before it; older state goes.
        _drop_state(spark, base, number)


def _drop_state(spark: SparkSession, base: str, before: int) -> None:
    """Delete the open windows and clock of the last batch finished before a number."""
    last = _clock(spark, base, before=before)
    if last:
        discard(spark, f"{_at(base, WINDOWS, last[0])}/closed=false")
        discard(spark, _at(base, CLOCK, last[0]))


def run_health(
    measured: DataFrame,
    measures: Measures,
    base: str,
    checkpoint_path: str,
    late_by: timedelta = LATE_BY,
) -> None:
    """Take what has come on a stream since the last call, then return."""

    def take(rows: DataFrame, batch: int) -> None:
        take_batch(rows, batch, base, measures, late_by)

    query = (
        measured.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _finished(spark: SparkSession, base: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of the finished batches of a table."""
    last = _clock(spark, base)
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/{table}").filter(c(BATCH) <= last[0])


def scan_windows(spark: SparkSession, base: str, *, open_too: bool = False) -> DataFrame:
    """The windows given out, with alarms; with ``open_too`` also those that still grow."""
    rows = _finished(spark, base, WINDOWS, _PLACED)
    shown = c("closed")
    if open_too:
        last = _clock(spark, base)
        shown = shown | (c(BATCH) == (last[0] if last else -1))
    return with_alarms(rows.filter(shown))


def scan_late(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Late rows as they came, and rows without a time, with the batch each came in."""
    placed = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return _finished(spark, base, LATE, placed)


def corrected_windows(
    spark: SparkSession, base: str, schema: T.StructType, measures: Measures
) -> DataFrame:
    """All windows as of all rows, late ones too, whatever order they came in."""
    late = measures.windows(scan_late(spark, base, schema)).drop("newest")
    known = scan_windows(spark, base, open_too=True).select(*late.columns)
    return with_alarms(merged_windows(known.unionByName(late)))
