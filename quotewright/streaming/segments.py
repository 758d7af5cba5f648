"""Segments of the incremental log: a base and deltas for each day, merged by size.

A batch leaves a segment, a folder with a partition for each day it touches. A
ledger says which segments of a day are complete, what span of batches each
covers and how many rows were put in. Segments of a day are merged, newest
first, as long as the next older one is no larger than all newer ones together.
So a row is merged again only into a segment of twice the size, and a day has
few segments, however many batches come. What a merge replaces is covered by
its span and counts no more.

Every step may be repeated: data are written before the ledger names them, a
segment written again replaces itself, and rows that come in twice are one row
to the merge. The ledger has a row for each day and segment, so the days of the
calendar and the logarithm of the batches bound what the driver reads of it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curate import keep_latest, with_market_date
from ..schemas import BRANCHES, CURATED, PARTITION_COLUMNS, QUOTE_COLUMNS, REJECTED, REJECTED_BRANCH, VALID_BRANCH
from ..sources.files import write_branches
from ..sources.scratch import discard

DAY = list(PARTITION_COLUMNS)
LEDGER = "year string, month string, day string, segment string, low long, high long, rows long"
PUBLISHED = "year string, month string, day string, high long"
# An older segment joins a merge if it has at most so many times the rows of the newer ones.
RATIO = 1
# Commits after which a ledger is written as one again.
FOLD_COMMITS = 50

Day = tuple[str, str, str]


class Segment(NamedTuple):
    """A segment's part of one day: the batches it covers, the rows put in."""

    year: str
    month: str
    day: str
    segment: str
    low: int
    high: int
    rows: int

    @property
    def date(self) -> Day:
        return self[:3]


def _rows_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}/rows"


def _commit_path(log_path: str, ledger: str, commit: str) -> str:
    return f"{log_path.rstrip('/')}/{ledger}/commit={commit}"


def _entries(spark: SparkSession, log_path: str, ledger: str, schema: str) -> list:
    """All rows of a ledger with their ``commit``."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(_commit_path(log_path, ledger, "none"))
    path = f"{log_path.rstrip('/')}/{ledger}"
    return spark.read.schema(f"{schema}, commit string").parquet(path).collect()


def _commit(spark: SparkSession, rows: Iterable, log_path: str, ledger: str, schema: str, commit: str) -> None:
    frame = spark.createDataFrame(list(rows), schema).coalesce(1)
    frame.write.mode("overwrite").parquet(_commit_path(log_path, ledger, commit))


def segments(spark: SparkSession, log_path: str) -> list[Segment]:
    """All segments that are complete, replaced ones too."""
    return sorted({Segment(*row[:7]) for row in _entries(spark, log_path, "ledger", LEDGER)})


def live_segments(known: Iterable[Segment]) -> list[Segment]:
    """The segments no other covers: spans of a day are apart or one within another."""
    out, reached = [], {}
    for part in sorted(known, key=lambda s: (s.date, s.low, -s.high, s.segment)):
        if part.high > reached.get(part.date, -1):
            out.append(part)
            reached[part.date] = part.high
    return out


def due_merges(live: Iterable[Segment]) -> dict[Segment, list[Segment]]:
    """What is due to be merged, by the segment that is to come of it."""
    days = defaultdict(list)
    for part in sorted(live, key=lambda s: -s.high):
        days[part.date].append(part)
    out = {}
    for date, parts in days.items():
        count, rows = 1, parts[0].rows
        while count < len(parts) and parts[count].rows <= RATIO * rows:
            rows += parts[count].rows
            count += 1
        if count > 1:
            low, high = parts[count - 1].low, parts[0].high
            out[Segment(*date, f"m{low:012d}-{high:012d}", low, high, rows)] = parts[:count]
    return out


def log_rows(spark: SparkSession, log_path: str, chosen: Iterable[Segment]) -> DataFrame:
    """The valid rows of some segments' days.

    Only the folders of these segments are listed, and the days go to the scan
    as a runtime filter on its partitions: others are not read.
    """
    root = _rows_path(log_path)
    wanted = {(*part.date, part.segment) for part in chosen}
    schema = f"{CURATED.toDDL()}, segment STRING, branch STRING"
    paths = [f"{root}/segment={name}/branch={VALID_BRANCH}" for name in sorted({key[3] for key in wanted})]
    if not paths:
        return spark.createDataFrame([], CURATED)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    days = spark.createDataFrame(sorted(wanted), ", ".join(f"{name} string" for name in (*DAY, "segment")))
    # Says nothing about the rows, but the planner prunes for a filtered side only.
    days = days.filter(F.col("year") >= "")
    return rows.join(F.broadcast(days), [*DAY, "segment"], "left_semi").select(*CURATED.names)


def write_segment(split: DataFrame, log_path: str, name: str) -> None:
    """Write both branches of a batch as its segment, in one job."""
    write_branches(split.withColumn("segment", F.lit(name)), _rows_path(log_path), DAY, ["segment"])


def segment_counts(spark: SparkSession, log_path: str, name: str) -> tuple[dict[Day, int], int]:
    """The valid rows of a batch's segment by day, and its rejected rows."""
    path = f"{_rows_path(log_path)}/segment={name}"
    counted = spark.read.schema(BRANCHES).parquet(path).groupBy("branch", *DAY).count().collect()
    valid = {tuple(row[n] for n in DAY): row["count"] for row in counted if row["branch"] == VALID_BRANCH}
    return valid, sum(row["count"] for row in counted if row["branch"] == REJECTED_BRANCH)


def segment_rejected(spark: SparkSession, log_path: str, name: str) -> DataFrame:
    """The rejected rows of a batch's segment."""
    rows = spark.read.schema(BRANCHES).parquet(f"{_rows_path(log_path)}/segment={name}")
    return rows.filter(F.col("branch") == REJECTED_BRANCH).select(*REJECTED.names)


def commit_segment(
    spark: SparkSession, log_path: str, name: str, days: dict[Day, int], known: list[Segment]
) -> list[Segment]:
    """Enter a batch's written segment into the ledger, after all before it."""
    if any(part.segment == name for part in known):
        return known
    number = max((part.high for part in known), default=-1) + 1
    own = [Segment(*date, name, number, number, rows) for date, rows in sorted(days.items())]
    if own:
        _commit(spark, own, log_path, "ledger", LEDGER, name)
    return known + own


def merge(spark: SparkSession, log_path: str, due: dict[Segment, list[Segment]]) -> None:
    """Make the due merges of all days, in one job, and enter them into the ledger."""
    if not due:
        return
    latest = keep_latest(log_rows(spark, log_path, (p for parts in due.values() for p in parts)), DAY)
    names = spark.createDataFrame(
        [(*new.date, new.segment) for new in due], ", ".join(f"{n} string" for n in (*DAY, "segment"))
    )
    kinds = {f.name: f.dataType for f in BRANCHES}
    blank = {n: F.lit(None).cast(kinds[n]) for n in ("source_file", "rejection_reason", "rejected_at")}
    rows = latest.join(F.broadcast(names), DAY).withColumns({**blank, "branch": F.lit(VALID_BRANCH)})
    write_branches(rows.select(*BRANCHES.names, "segment"), _rows_path(log_path), DAY, ["segment"])
    _commit(spark, due, log_path, "ledger", LEDGER, f"merge-{max(new.high for new in due):012d}")


def current_rows(spark: SparkSession, log_path: str, days: Iterable[Day], known: list[Segment]) -> DataFrame:
    """The latest valid row of each key of the given days, merged on reading."""
    wanted = set(days)
    live = [part for part in live_segments(known) if part.date in wanted]
    return with_market_date(keep_latest(log_rows(spark, log_path, live).select(*QUOTE_COLUMNS)))


def published_days(spark: SparkSession, log_path: str) -> dict[Day, int]:
    """The published days with the last batch that is in them."""
    out: dict[Day, int] = {}
    for row in _entries(spark, log_path, "published", PUBLISHED):
        date = tuple(row[:3])
        out[date] = max(row["high"], out.get(date, -1))
    return out


def commit_published(spark: SparkSession, log_path: str, days: dict[Day, int]) -> None:
    rows = [(*date, high) for date, high in sorted(days.items())]
    name = f"{max(days.values()):012d}-{len(days)}-{min(days.values())}"
    _commit(spark, rows, log_path, "published", PUBLISHED, name)


def clear_replaced(spark: SparkSession, log_path: str, known: list[Segment]) -> None:
    """Delete the data of days that a merge has replaced.

    Called before a batch, so that whoever read the log while the last one ran
    still finds its files.
    """
    for part in set(known) - set(live_segments(known)):
        date = "/".join(f"{name}={value}" for name, value in zip(DAY, part.date))
        path = f"{_rows_path(log_path)}/segment={part.segment}"
        discard(spark, f"{path}/branch={VALID_BRANCH}/{date}")


def fold_ledgers(spark: SparkSession, log_path: str) -> None:
    """Write a ledger of many commits as one again, without what ``clear_replaced`` has deleted.

    The fold says the same as what it takes the place of, so both may stand for
    a while, and a crash between the two leaves what was.
    """
    for ledger, schema in (("ledger", LEDGER), ("published", PUBLISHED)):
        entries = _entries(spark, log_path, ledger, schema)
        commits = {row["commit"] for row in entries}
        if len(commits) <= FOLD_COMMITS:
            continue
        if ledger == "ledger":
            kept: list = live_segments({Segment(*row[:7]) for row in entries})
        else:
            kept = [(*date, high) for date, high in published_days(spark, log_path).items()]
        fold = "fold-b" if "fold-a" in commits else "fold-a"
        _commit(spark, kept, log_path, ledger, schema, fold)
        for commit in commits - {fold}:
            discard(spark, _commit_path(log_path, ledger, commit))
