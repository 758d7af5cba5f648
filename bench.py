"""Time the main jobs and reports; print one line of JSON.

The jobs start from line files, as they do in use, and the reports and checks
run on the curated table the first job stored.
"""

from __future__ import annotations

import json
import os
import time
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.operators import analytics, operations, standardize
from quotewright.operators.curate import assess, curated_quotes, rejected_quotes
from quotewright.plans.jobs import curate, replay
from quotewright.plans.reports import CHECKS, REPORTS
from quotewright.session import SETTINGS, shared_dir
from quotewright.sources import files
from quotewright.sources import sample_tables as sample
from quotewright.streaming.incremental import run_incremental

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

TIMED = {
    **REPORTS,
    "quotes_between": lambda q: analytics.quotes_between(q, date(2024, 1, 8), date(2024, 1, 9)),
    **CHECKS,
    "missing_slots": operations.missing_slots,
}


def run(frame: DataFrame) -> None:
    """Work out every row and column, and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    """Seconds of the second run; the first compiles the generated code."""
    for _ in range(2):
        began = time.perf_counter()
        work()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    folder = shared_dir(spark, f"bench-{uuid4().hex}")
    # The zones the jobs start from, as line files; not counted.
    spread = int(CPUS)
    zones = {
        "events": sample.standardized_from_events(spark, SF_DIR),
        "lineitem": sample.quotes_from_lineitem(spark, SF_DIR),
        "responses": sample.responses_from_events(spark, SF_DIR),
    }
    for name, rows in zones.items():
        rows.repartition(spread).write.json(f"{folder}/{name}")
    responses = spark.read.schema(zones["responses"].schema).json(f"{folder}/responses")

    curated: list[str] = []

    def curate_zone(name: str) -> None:
        zones = f"{folder}/{name}-{uuid4().hex}"
        curate(
            spark, f"{folder}/{name}", f"{zones}/curated", f"{zones}/rejected", sample.RUN_TIME
        )
        curated.append(f"{zones}/curated")

    def stream_zone() -> None:
        zones = f"{folder}/stream-{uuid4().hex}"
        names = ("curated", "rejected", "log", "checkpoint")
        run_incremental(
            spark, f"{folder}/events", *(f"{zones}/{name}" for name in names), sample.RUN_TIME, max_files=4
        )

    ingested = standardize.ingest(responses)
    events = sample.table(spark, SF_DIR, "events")
    rejected = rejected_quotes(
        assess(files.scan_standardized(spark, f"{folder}/events")), sample.RUN_TIME
    )
    universe = standardize.symbol_universe(sample.requests_from_nations(spark, SF_DIR))
    seconds = {
        "curate_events": timed(lambda: curate_zone("events")),
        "curate_plan_lineitem": timed(
            lambda: run(curated_quotes(files.scan_standardized(spark, f"{folder}/lineitem")))
        ),
        "ingest": timed(lambda: run(ingested)),
        "ingest_summary": timed(lambda: run(standardize.ingest_summary(ingested))),
        "failed_symbols": timed(lambda: run(standardize.failed_symbols(ingested))),
        "replay_from_raw": timed(lambda: run(replay(responses))),
        "incremental_curated": timed(stream_zone),
        "write_raw": timed(lambda: files.write_raw(standardize.raw_zone(ingested), f"{folder}/raw")),
        "write_rejected": timed(
            lambda: files.write_rejected(rejected, f"{folder}/rejected", mode="overwrite")
        ),
        "rejected_report": timed(lambda: run(operations.rejected_report(rejected))),
        "health_windows": timed(
            lambda: run(
                operations.health_windows(
                    events,
                    "ts",
                    errors=F.col("event_type") == "error",
                    throttles=F.col("event_type") == "signup",
                    duration_ms=F.col("value") * 100,
                )
            )
        ),
    }
    quotes = files.scan_curated(spark, curated[-1])
    seconds["universe_quotes"] = timed(lambda: run(operations.restrict_to(quotes, universe)))
    for name, report in TIMED.items():
        seconds[name] = timed(lambda: run(report(quotes)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
