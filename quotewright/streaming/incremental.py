"""Incremental curation: only new standardized files are read.

Each micro-batch is typed, checked, deduplicated and split in one job, which
reads its files once and leaves both branches in the log as a segment
(``segments``). Segments of a day are merged by size, so a log row is read a
few times, however many batches its day gets. At the end of a run the days it
touched are published: their curated partitions are rebuilt from the log. With
``open_days`` the newest days stay open and are not published yet; then
``scan_current`` gives the whole state, merging the open days on reading.

Each step may be repeated: a crash at any point is repaired by running again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curate import assess, split_quotes
from ..schemas import CURATED, PARTITION_COLUMNS, QUOTE_COLUMNS, STANDARDIZED
from ..session import sized
from ..sources.files import scan_curated, write_curated, write_rejected
from . import segments

# Files of a batch; the rest follows in the next ones, so a first start over a
# large backlog is taken in steps.
FILES_PER_BATCH = 10_000


def _stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The query's id, which lives in its checkpoint.

    A new checkpoint counts its batches from zero again, and they must not
    replace those of the old one.
    """
    line = spark.read.text(f"{checkpoint_path.rstrip('/')}/metadata").first()
    return json.loads(line["value"])["id"]


def due_days(
    spark: SparkSession, log_path: str, known: list[segments.Segment], open_days: int | None = None
) -> dict[segments.Day, int]:
    """The days with batches that are not published, without the newest ``open_days``."""
    last: dict[segments.Day, int] = {}
    for part in known:
        last[part.date] = max(part.high, last.get(part.date, -1))
    published = segments.published_days(spark, log_path)
    due = {day: high for day, high in last.items() if published.get(day, -1) < high}
    if open_days is None or not last:
        return due
    first_open = date(*map(int, max(last))) - timedelta(days=open_days)
    return {day: high for day, high in due.items() if date(*map(int, day)) <= first_open}


def publish(
    spark: SparkSession,
    log_path: str,
    curated_path: str,
    days: Iterable[segments.Day],
    known: list[segments.Segment],
) -> None:
    """Rebuild the curated partitions of the given days from the log."""
    rows = segments.current_rows(spark, log_path, days, known)
    write_curated(rows, curated_path, mode="overwrite")


def publish_due(
    spark: SparkSession, log_path: str, curated_path: str, open_days: int | None = None
) -> None:
    """Publish the due days, and remember up to which batch."""
    known = segments.segments(spark, log_path)
    due = due_days(spark, log_path, known, open_days)
    if due:
        publish(spark, log_path, curated_path, due, known)
        segments.commit_published(spark, log_path, due)


def scan_current(spark: SparkSession, log_path: str, curated_path: str) -> DataFrame:
    """The curated state of all batches: published days as they are, others merged from the log.

    For ``run_incremental`` with ``open_days``. The days, a row for each one of
    the calendar at most, are looked up when this is called.
    """
    known = segments.segments(spark, log_path)
    due = due_days(spark, log_path, known)
    merged = segments.current_rows(spark, log_path, due, known).select(*CURATED.names)
    if not segments.published_days(spark, log_path):
        return merged
    days = spark.createDataFrame(sorted(due), ", ".join(f"{name} string" for name in PARTITION_COLUMNS))
    settled = scan_curated(spark, curated_path)
    settled = settled.join(F.broadcast(days), list(PARTITION_COLUMNS), "left_anti")
    return settled.select(*CURATED.names).unionByName(merged)


def take_batch(
    batch: DataFrame, name: str, log_path: str, rejected_path: str, run_timestamp: datetime
) -> None:
    """Bring one batch into the log and write its rejected rows."""
    spark = sized(batch)
    known = segments.segments(spark, log_path)
    segments.clear_replaced(spark, log_path, known)
    segments.fold_ledgers(spark, log_path)
    segments.write_segment(split_quotes(assess(batch), run_timestamp), log_path, name)
    days, rejected = segments.segment_counts(spark, log_path, name)
    if rejected:
        rows = segments.segment_rejected(spark, log_path, name)
        write_rejected(rows, f"{rejected_path}/batch={name}", mode="overwrite")
    known = segments.commit_segment(spark, log_path, name, days, known)
    touched = [part for part in segments.live_segments(known) if part.date in days]
    segments.merge(spark, log_path, segments.due_merges(touched))


def run_incremental(
    spark: SparkSession,
    source_path: str,
    curated_path: str,
    rejected_path: str,
    log_path: str,
    checkpoint_path: str,
    run_timestamp: datetime,
    max_files: int = FILES_PER_BATCH,
    open_days: int | None = None,
) -> None:
    """Curate the files that came since the last call, ``max_files`` at a time, then return.

    All touched days are published at the end; with ``open_days`` only those
    that lie so many days before the newest one, or more.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        # A batch has a session of its own, which its queries run in.
        name = f"{_stream_id(batch.sparkSession, checkpoint_path)}-{batch_id}"
        take_batch(batch, name, log_path, rejected_path, run_timestamp)

    reader = spark.readStream.schema(STANDARDIZED).option("maxFilesPerTrigger", max_files)
    files = reader.json(source_path)
    rows = files.select(*QUOTE_COLUMNS, F.col("_metadata.file_path").alias("source_file"))
    query = (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    publish_due(spark, log_path, curated_path, open_days)
