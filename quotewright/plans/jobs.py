"""The ingest, curation and replay jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..functions.times import utc_literal
from ..operators.curate import assess, curated_quotes, split_quotes
from ..operators.standardize import (
    failed_symbols,
    ingest,
    ingest_summary,
    raw_zone,
    standardized_zone,
)
from ..schemas import CURATED, REJECTED, REJECTED_BRANCH, VALID_BRANCH
from ..session import kept_sizes, shared_dir, sized
from ..sources.files import (
    publish_run,
    replayable,
    scan_branch,
    scan_raw,
    scan_standardized,
    write_branches,
)
from ..sources.scratch import discard, scratch_folder, store

Writer = Callable[[DataFrame], str]


@dataclass(frozen=True)
class IngestResult:
    """What a run did.

    ``failures`` has all failed symbols as rows, in request order, from the
    stored run; ``close`` deletes that, and the failures with it. The
    locations are None where there was nothing to write.
    """

    requested_count: int
    successful_count: int
    failed_count: int
    failures: DataFrame
    raw_location: str | None
    standardized_location: str | None
    stored_run: str

    def close(self) -> None:
        discard(self.failures.sparkSession, self.stored_run)


def run_ingestion(
    responses: DataFrame,
    run_timestamp: datetime,
    raw_writer: Writer,
    standardized_writer: Writer,
) -> IngestResult:
    """Ingest a run's responses and hand each zone's rows to its writer.

    ``responses`` has ``position``, ``requested_symbol`` and ``response``. A
    bad response stops no other. The parsed run is written to the shared
    folder and all outputs are fed from there: each response is read and
    parsed once, and a source that gives something else the next time does no
    harm.
    """
    spark = responses.sparkSession
    path = shared_dir(spark, "runs", f"{run_timestamp:%Y%m%dT%H%M%SZ}-{uuid4().hex}")
    parsed = ingest(responses.withColumn("run_timestamp", utc_literal(run_timestamp)))
    rows = store(parsed.drop("raw", "keys"), path)
    counts = ingest_summary(rows).first()
    raw, standardized = raw_zone(rows), standardized_zone(rows)
    raw_location = None if raw.isEmpty() else raw_writer(raw)
    any_good = counts is not None and counts["successful_count"] > 0
    standardized_location = standardized_writer(standardized) if any_good else None
    return IngestResult(
        requested_count=counts["requested_count"] if counts else 0,
        successful_count=counts["successful_count"] if counts else 0,
        failed_count=counts["failed_count"] if counts else 0,
        failures=failed_symbols(rows),
        raw_location=raw_location,
        standardized_location=standardized_location,
        stored_run=path,
    )


@dataclass(frozen=True)
class CurateResult:
    """Which outputs of a curation run were written."""

    curated_written: bool
    rejected_written: bool


def curate(
    spark: SparkSession,
    source: DataFrame | str,
    curated_path: str,
    rejected_path: str,
    run_timestamp: datetime,
) -> CurateResult:
    """Curate a standardized zone (a frame or a path) into both outputs.

    The source is read once: one job types, checks, deduplicates and splits it
    into Parquet in the shared folder, and both outputs are published from
    there, each as the run's own partitions (``run_id=`` below the day). The
    run again replaces its rows instead of adding them twice. An output
    without rows is not written.
    """
    if isinstance(source, str):
        source = scan_standardized(spark, source)
    run = f"{run_timestamp:%Y%m%dT%H%M%SZ}"
    with kept_sizes(spark), scratch_folder(spark, "curate") as staged:
        sized(source)
        write_branches(split_quotes(assess(source), run_timestamp), staged)
        written = {}
        for branch, path, names in (
            (VALID_BRANCH, curated_path, CURATED.names),
            (REJECTED_BRANCH, rejected_path, REJECTED.names),
        ):
            rows = scan_branch(spark, staged, branch).select(*names)
            written[branch] = not rows.isEmpty()
            if written[branch]:
                publish_run(rows, path, run)
    return CurateResult(written[VALID_BRANCH], written[REJECTED_BRANCH])


def replay(responses: DataFrame) -> DataFrame:
    """Raw responses to curated quotes, in one plan."""
    sized(responses)
    return curated_quotes(standardized_zone(ingest(responses)))


def replay_zone(
    spark: SparkSession,
    raw_path: str,
    curated_path: str,
    rejected_path: str,
    run_timestamp: datetime,
    first: date | None = None,
    last: date | None = None,
) -> CurateResult:
    """Curate the raw zone, or its runs of some dates, into both outputs again."""
    raw = scan_raw(spark, raw_path, first, last)
    quotes = standardized_zone(ingest(replayable(raw)))
    return curate(spark, quotes, curated_path, rejected_path, run_timestamp)
