"""Registered queries: every operator over the sample tables.

``queries`` gives the Spark side, ``oracle_sql`` the same results as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oracle.sql import QUERIES as ORACLE
from quotewright.functions.times import run_id
from quotewright.operators import (
    analytics,
    check_states,
    operations,
    rollups,
    standardize,
    symbol_sets,
)
from quotewright.operators.curate import assess, rejected_quotes, split_quotes, typed_quotes
from quotewright.plans.jobs import replay
from quotewright.plans.reports import CHECKS, REPORTS
from quotewright.plans.rollups import (
    refresh,
    refresh_symbol_sets,
    scan_rollup,
    scan_symbol_sets,
)
from quotewright.schemas import CURATED, PARTITION_COLUMNS, QUOTE_COLUMNS, REJECTED, REJECTED_BRANCH
from quotewright.session import configure, shared_dir
from quotewright.sources import files
from quotewright.sources import sample_tables as sample
from quotewright.sources.catalog import update_table
from quotewright.sources.scratch import discard
from quotewright.streaming import late
from quotewright.streaming.incremental import run_incremental, scan_current

try:  # the corpus operators may be left out
    import corpus_pipeline
    from quotewright.llm import queries as corpus
except ModuleNotFoundError as error:
    if (error.name or "") not in ("corpus_pipeline", "quotewright.llm"):
        raise
    corpus = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]
Operator = Callable[[DataFrame], DataFrame]

AS_OF = date(2024, 4, 15)
FIRST, LAST = date(2024, 1, 8), date(2024, 1, 19)


def entry(spark: SparkSession) -> DataFrame:
    """Curate the smallest sample and report the latest quote per symbol."""
    return queries()["latest_quote"](spark, "/root/testdata/sf0.001")


def _on(source: Query, operator: Operator) -> Query:
    return lambda spark, sf_dir: operator(source(configure(spark), sf_dir))


def _on_curated(operator: Operator) -> Query:
    return _on(sample.curated_from_events, operator)


def _on_faulty(operator: Operator) -> Query:
    return _on(sample.faulty_from_events, operator)


def _on_valid(operator: Operator) -> Query:
    return _on(sample.valid_from_events, operator)


def _on_responses(operator: Operator) -> Query:
    return _on(sample.responses_from_events, operator)


def _folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder per application, name and scale."""
    return shared_dir(configure(spark), name, sf_dir.rstrip("/").rsplit("/", 1)[-1])


# --- sources and sinks --------------------------------------------------------


def _standardized_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized rows; a run is a day of events."""
    rows = sample.standardized_from_events(spark, sf_dir)
    return rows.withColumn("run_timestamp", F.date_trunc("day", "ts").cast("timestamp_ntz"))


def _scan_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, sf_dir, "standardized")
    files.write_standardized(_standardized_runs(spark, sf_dir), path)
    return files.scan_standardized(spark, path).select(*QUOTE_COLUMNS)


def _scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, sf_dir, "raw")
    files.write_raw(sample.responses_from_events(spark, sf_dir), path)
    return files.scan_raw(spark, path).select("run_id", "response")


def _to_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample.standardized_from_events(configure(spark), sf_dir)
    return standardize.to_jsonl(rows.select(*QUOTE_COLUMNS))


def _run_partitions(responses: DataFrame) -> DataFrame:
    rows = files.with_run_partitions(responses, hourly=True)
    return rows.select("position", *PARTITION_COLUMNS, "hour", "run_id")


def _curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, sf_dir, "curated")
    files.write_curated(sample.curated_from_events(spark, sf_dir), path, mode="overwrite")
    return files.scan_curated(spark, path)


def _rejected_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, sf_dir, "rejected")
    rows = rejected_quotes(sample.assessed_from_events(spark, sf_dir), sample.RUN_TIME)
    files.write_rejected(rows, path, mode="overwrite")
    return files.scan_rejected(spark, path)


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.symbol_universe(sample.requests_from_nations(spark, sf_dir))


def _universe_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = sample.curated_from_events(configure(spark), sf_dir)
    return operations.restrict_to(quotes, _universe(spark, sf_dir)).select(*QUOTE_COLUMNS)


# --- raw to standardized ------------------------------------------------------


def _classified(responses: DataFrame) -> DataFrame:
    return standardize.classify_responses(responses).select("position", "status", "detail")


def _standardized(responses: DataFrame) -> DataFrame:
    rows = standardize.standardize_quotes(standardize.classify_responses(responses))
    return rows.filter(F.col("status") == standardize.OK).select("position", *QUOTE_COLUMNS)


def _validated(responses: DataFrame) -> DataFrame:
    return standardize.ingest(responses).select("position", "status", "detail")


def _ingest_split(responses: DataFrame) -> DataFrame:
    """Both outputs of the split, under one another."""
    rows = standardize.ingest(responses)
    good = rows.filter(F.col("status") == standardize.OK).select(
        run_id(F.col("run_timestamp")).alias("run_id"),
        "position",
        F.lit("standardized").alias("zone"),
        "symbol",
        "status",
        "detail",
    )
    failed = standardize.failed_symbols(rows).select(
        "run_id",
        "position",
        F.lit("failed").alias("zone"),
        F.col("requested_symbol").alias("symbol"),
        "status",
        "detail",
    )
    return good.unionByName(failed)


def _ingest_summary(responses: DataFrame) -> DataFrame:
    return standardize.ingest_summary(standardize.ingest(responses))


def _failed_symbols(responses: DataFrame) -> DataFrame:
    return standardize.failed_symbols(standardize.ingest(responses))


def _replay_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses through the files of the raw zone to curated quotes."""
    path = _folder(spark, sf_dir, f"replay-{uuid4().hex}")
    rows = standardize.ingest(sample.responses_from_events(spark, sf_dir))
    files.write_raw(standardize.raw_zone(rows), path)
    return replay(files.replayable(files.scan_raw(spark, path)))


# --- curation -----------------------------------------------------------------


def _typed(standardized: DataFrame) -> DataFrame:
    return typed_quotes(standardized).select(*QUOTE_COLUMNS)


def _reasons(assessed: DataFrame) -> DataFrame:
    return assessed.groupBy("rejection_reason").agg(F.count("*").alias("row_count"))


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = sample.assessed_from_events(configure(spark), sf_dir)
    return rejected_quotes(assessed, sample.RUN_TIME)


# --- operations ---------------------------------------------------------------


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized files curated by the stream, a few files at a time."""
    base = _folder(spark, sf_dir, f"incremental-{uuid4().hex}")
    source, curated = f"{base}/standardized", f"{base}/curated"
    files.write_standardized(_standardized_runs(spark, sf_dir), source)
    run_incremental(
        spark,
        source,
        curated,
        f"{base}/rejected",
        f"{base}/log",
        f"{base}/checkpoint",
        sample.RUN_TIME,
        max_files=12,
    )
    return files.scan_curated(spark, curated)


def _incremental_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state while the newest days are still open, merged on reading."""
    base = _folder(spark, sf_dir, f"incremental-{uuid4().hex}")
    source, log, curated = f"{base}/standardized", f"{base}/log", f"{base}/curated"
    files.write_standardized(_standardized_runs(spark, sf_dir), source)
    paths = (source, curated, f"{base}/rejected", log, f"{base}/checkpoint")
    run_incremental(spark, *paths, sample.RUN_TIME, max_files=12, open_days=20)
    return scan_current(spark, log, curated)


def _split_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows as the curation job leaves them beside the curated ones."""
    base = _folder(spark, sf_dir, f"split-{uuid4().hex}")
    rows = sample.standardized_from_events(configure(spark), sf_dir)
    files.write_branches(split_quotes(assess(rows), sample.RUN_TIME), base)
    return files.scan_branch(spark, base, REJECTED_BRANCH).select(*REJECTED.names)


def _from_rollup(name: str, report: Operator) -> Query:
    """A report from a rollup of the curated quotes, written and read again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _folder(spark, sf_dir, f"rollups-{uuid4().hex}")
        refresh(sample.curated_from_events(configure(spark), sf_dir), path, names=[name])
        return report(scan_rollup(spark, path, name))

    return query


def _merged_latest(quotes: DataFrame) -> DataFrame:
    """Newest quotes of odd and even minutes, rolled up apart and merged."""
    odd = F.coalesce(F.minute("market_timestamp") % 2 == 1, F.lit(False))
    parts = [rollups.daily_latest(quotes.filter(half)) for half in (odd, ~odd)]
    return analytics.latest_quote(rollups.merged_latest(*parts))


def _report_of_states(quotes: DataFrame) -> DataFrame:
    states, strays = check_states.check_states(quotes), check_states.stray_keys(quotes)
    return check_states.report_of(states, strays, quotes)


def _from_symbol_sets(report: Operator) -> Query:
    """A report from symbol sets of the days' first half, then of the other days."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _folder(spark, sf_dir, f"rollups-{uuid4().hex}")
        quotes = sample.curated_from_events(configure(spark), sf_dir)
        early = F.col("day") <= "15"
        refresh_symbol_sets(quotes.filter(early), path)
        seen = quotes.filter(~early).select(*PARTITION_COLUMNS).distinct().collect()
        days = [date(*(int(part) for part in row)) for row in seen]
        refresh_symbol_sets(quotes, path, days)
        return report(scan_symbol_sets(spark, path))

    return query


def _moving_avg_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving averages of some days, from their quotes and the tails of the days before."""
    path = _folder(spark, sf_dir, f"rollups-{uuid4().hex}")
    quotes = sample.curated_from_events(configure(spark), sf_dir)
    refresh(quotes, path, names=["tails"])
    tails = scan_rollup(spark, path, "tails")
    return rollups.moving_avg_between(quotes, tails, FIRST, LAST)


def _catalog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a table of days up to the 20th is told of a folder of those from the 10th on."""
    path = _folder(spark, sf_dir, f"catalog-{uuid4().hex}")
    quotes, table = sample.curated_from_events(spark, sf_dir), f"quotes_{uuid4().hex}"
    narrow = StructType([f for f in CURATED if f.name != "source"])
    try:
        files.write_curated(quotes.filter("day <= '20'"), path)
        update_table(spark, table, path, narrow)
        discard(spark, path)
        files.write_curated(quotes.filter("day >= '10'"), path)
        return update_table(spark, table, path, CURATED).select("kind", "name")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operations.health_windows(
        sample.table(configure(spark), sf_dir, "events"),
        "ts",
        errors=F.col("event_type") == "error",
        throttles=F.col("event_type") == "signup",
        duration_ms=F.col("value") * 100,
    )


def _health_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health windows from a stream of events in files of a month's same day, late rows merged."""
    base = _folder(spark, sf_dir, f"health-{uuid4().hex}")
    events = sample.table(configure(spark), sf_dir, "events").select("ts", "event_type", "value")
    day = F.dayofmonth("ts").alias("part")
    events.select("*", day).hint("rebalance", "part").write.partitionBy("part").json(f"{base}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8)
    measures = late.Measures(
        "ts", "event_type = 'error'", "event_type = 'signup'", "value * 100"
    )
    late.run_health(stream.json(f"{base}/events"), measures, base, f"{base}/checkpoint")
    return late.corrected_windows(spark, base, events.schema, measures)


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day partitions of all zones, taking a day of events for a run."""
    events = sample.table(configure(spark), sf_dir, "events")
    runs = files.with_run_partitions(events.withColumnRenamed("ts", "run_timestamp"), hourly=False)
    zones = [*operations.RETENTION_DAYS, "curated"]
    days = operations.zone_partitions(runs, "")
    return days.select(F.explode(F.array(*map(F.lit, zones))).alias("zone"), *PARTITION_COLUMNS)


def queries() -> dict[str, Query]:
    """Each operator as a function of a session and a folder of sample tables."""
    standardized = sample.standardized_from_events
    extra = corpus.queries() | {"pipeline": corpus_pipeline.run} if corpus else {}
    return extra | {
        # sources and sinks
        "scan_standardized": _scan_standardized,
        "scan_raw": _scan_raw,
        "to_jsonl": _to_jsonl,
        "run_partitions": _on_responses(_run_partitions),
        "curated_roundtrip": _curated_roundtrip,
        "rejected_roundtrip": _rejected_roundtrip,
        "symbol_universe": _universe,
        "universe_quotes": _universe_quotes,
        # raw to standardized
        "classify_responses": _on_responses(_classified),
        "standardize_quotes": _on_responses(_standardized),
        "validate_quotes": _on_responses(_validated),
        "ingest_split": _on_responses(_ingest_split),
        "ingest_summary": _on_responses(_ingest_summary),
        "failed_symbols": _on_responses(_failed_symbols),
        # curation
        "typed_quotes": _on(standardized, _typed),
        "rejection_reasons": _on(sample.assessed_from_events, _reasons),
        "rejected_quotes": _rejected,
        "curated_quotes": _on_curated(lambda quotes: quotes),
        # reports
        **{name: _on_curated(report) for name, report in REPORTS.items()},
        "quotes_between": _on_curated(
            lambda quotes: analytics.quotes_between(quotes, FIRST, LAST)
        ),
        # quality checks
        **{name: _on_faulty(check) for name, check in CHECKS.items()},
        "dq_dup_keys": _on_valid(CHECKS["dq_dup_keys"]),
        "dq_dup_rows": _on_valid(CHECKS["dq_dup_rows"]),
        "dq_report_curated": _on_curated(CHECKS["dq_report"]),
        # reports and checks merged from rollups by day
        "rollup_volatility": _from_rollup("moments", rollups.volatility_of),
        "rollup_volatility_between": _from_rollup(
            "moments",
            lambda days: rollups.volatility_of(analytics.quotes_between(days, FIRST, LAST)),
        ),
        "rollup_latest_quote": _on_curated(_merged_latest),
        "rollup_market_breadth": _from_rollup("latest", analytics.market_breadth),
        "rollup_day_over_day": _from_rollup("latest", analytics.day_over_day),
        "rollup_freshness": _from_rollup("latest", rollups.freshness_of),
        "rollup_null_profile": _on_faulty(
            lambda quotes: check_states.null_profile_of(check_states.check_states(quotes))
        ),
        "rollup_scorecard": _on_faulty(
            lambda quotes: check_states.scorecard_of(check_states.check_states(quotes))
        ),
        "rollup_report": _on_faulty(_report_of_states),
        "rollup_exchange_summary": _from_symbol_sets(symbol_sets.exchange_summary_of),
        "rollup_exchange_summary_between": _from_symbol_sets(
            lambda sets: symbol_sets.exchange_summary_of(
                analytics.quotes_between(sets, FIRST, LAST)
            )
        ),
        "rollup_partition_summary": _from_symbol_sets(symbol_sets.partition_summary_of),
        "rollup_moving_avg_between": _moving_avg_between,
        # operations
        "catalog_changes": _catalog_changes,
        "incremental_curated": _incremental,
        "incremental_open": _incremental_open,
        "split_rejected": _split_rejected,
        "replay_from_raw": _replay_from_raw,
        "missing_slots": _on_curated(operations.missing_slots),
        "health_windows": _health,
        "health_windows_late": _health_by_day,
        "expired_partitions": _on(
            _zones, lambda zones: operations.expired_partitions(zones, AS_OF)
        ),
        "kept_partitions": _on(_zones, lambda zones: operations.kept_partitions(zones, AS_OF)),
        "rejected_report": _on(_rejected, operations.rejected_report),
    }


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL over the sample tables."""
    extra = corpus.oracle_sql() if corpus else {}
    if corpus and corpus_pipeline.ORACLE_SQL:
        extra = extra | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return extra | ORACLE
