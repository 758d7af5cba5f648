"""Sinks, scans, tables and the batch jobs."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quotewright.operators import standardize as st
from quotewright.plans.jobs import curate, replay, replay_zone, run_ingestion
from quotewright.plans.reports import write_reports
from quotewright.schemas import CURATED, CURATED_RUNS, RUN_PARTITIONS, DEFAULT_WATCHLIST, QUOTE_COLUMNS, STANDARDIZED
from quotewright.session import INITIAL_PARTITIONS, PARTITION_BYTES, configure, shared_dir, sized
from quotewright.sources import catalog, files
from quotewright.streaming.incremental import run_incremental
from tests.builders import RUN_TIME, plan_of, quote, quotes, response, responses, standardized

TEXT = response(name="Café 株", extra={"b": [1, 2]})


def folders(path) -> set[str]:
    root = Path(path)
    return {
        str(f.parent.relative_to(root))
        for f in root.rglob("part-*")
        if f.suffix in (".txt", ".json", ".parquet", ".csv")
    }


def test_raw_sink_keeps_lines_and_partitions_by_hour(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = st.raw_zone(st.ingest(responses(spark, TEXT, '{"status": "error"}')))
    files.write_raw(rows, path)
    assert folders(path) == {"year=2025/month=03/day=05/hour=14/run_id=20250305T142005Z"}
    row = files.scan_raw(spark, path).collect()
    assert [(r["run_id"], r["response"]) for r in row] == [("20250305T142005Z", TEXT)]


def test_standardized_sink(spark, tmp_path):
    path = str(tmp_path / "standardized")
    files.write_standardized(st.standardized_zone(st.ingest(responses(spark, TEXT))), path)
    assert folders(path) == {"year=2025/month=03/day=05/run_id=20250305T142005Z"}
    line = next(Path(path).rglob("part-*.json")).read_text(encoding="utf-8")
    record = json.loads(line)
    assert list(record) == list(QUOTE_COLUMNS)
    assert record["symbol"] == "NQRA" and record["volume"] == 731_204
    assert "Café 株" in line
    row = files.scan_standardized(spark, path).first()
    assert row["price"] == "64.25" and row["source_file"].endswith(".json")


def test_standardized_sink_writes_nulls(spark, tmp_path):
    path = str(tmp_path / "standardized")
    rows = standardized(spark, {"volume": None}).withColumn(
        "run_timestamp", F.lit(RUN_TIME).cast("timestamp_ntz")
    )
    files.write_standardized(rows, path)
    record = json.loads(next(Path(path).rglob("part-*.json")).read_text())
    assert "volume" in record and record["volume"] is None


def test_writing_a_run_again_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = responses(spark, response())
    later = first.withColumn(
        "run_timestamp", F.lit("2025-03-05 14:25:05").cast("timestamp_ntz")
    )
    for rows in (first, later, first):
        files.write_raw(st.raw_zone(st.ingest(rows)), path)
    runs = files.scan_raw(spark, path).groupBy("run_id").count().orderBy("run_id").collect()
    assert [tuple(r) for r in runs] == [("20250305T142005Z", 1), ("20250305T142505Z", 1)]


def test_raw_scan_of_dates_reads_their_partitions(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = responses(spark, response())
    files.write_raw(rows, path)
    files.write_raw(
        rows.withColumn("run_timestamp", F.lit("2025-03-06 01:00:00").cast("timestamp_ntz")), path
    )
    one = files.scan_raw(spark, path, first=date(2025, 3, 6))
    assert one.count() == 1
    assert "lpad(day" in plan_of(one).split("PartitionFilters: [")[1].split("]")[0]
    assert files.scan_raw(spark, path, last=date(2025, 3, 5)).count() == 1


def test_plain_day_folders_are_read_too(spark, tmp_path):
    """Files named by their run, without a run folder."""
    day = tmp_path / "raw" / "year=2025" / "month=03" / "day=05" / "hour=14"
    day.mkdir(parents=True)
    (day / "quotes_20250305T142005Z.jsonl").write_text(response() + "\n", encoding="utf-8")
    row = files.scan_raw(spark, str(tmp_path / "raw")).first()
    assert row["run_id"] == "20250305T142005Z" and row["response"] == response()


def test_ingestion_job(spark, tmp_path):
    rows = responses(
        spark,
        ("NQRA", response()),
        ("AMZN", '{"status": "error", "message": "API limit reached"}'),
        ("JPM", response(symbol="jpm", close="65")),
    ).drop("run_timestamp")
    raw, standard = str(tmp_path / "raw"), str(tmp_path / "standardized")

    def to(path, sink):
        def write(frame):
            sink(frame, path)
            return path

        return write

    result = run_ingestion(
        rows, RUN_TIME, to(raw, files.write_raw), to(standard, files.write_standardized)
    )
    assert (result.requested_count, result.successful_count, result.failed_count) == (3, 2, 1)
    assert [r["requested_symbol"] for r in result.failures.collect()] == ["AMZN"]
    assert result.failures.first()["detail"] == "API limit reached"
    assert (result.raw_location, result.standardized_location) == (raw, standard)
    assert files.scan_raw(spark, raw).count() == 2
    symbols = {r["symbol"] for r in files.scan_standardized(spark, standard).collect()}
    assert symbols == {"NQRA", "JPM"}


def test_ingestion_writes_nothing_if_all_fails(spark):
    def never(frame):
        raise AssertionError("nothing to write")

    rows = responses(spark, "not json", None).drop("run_timestamp")
    result = run_ingestion(rows, RUN_TIME, never, never)
    assert (result.raw_location, result.standardized_location) == (None, None)
    assert result.failed_count == 2
    empty = run_ingestion(rows.limit(0), RUN_TIME, never, never)
    assert empty.requested_count == 0 and empty.failures.isEmpty()


def curation(spark, tmp_path, *changes):
    source = str(tmp_path / "standardized")
    standardized(spark, *changes).write.json(source)
    out, rejected = str(tmp_path / "curated"), str(tmp_path / "rejected")
    return curate(spark, source, out, rejected, datetime(2025, 3, 6, 8)), out, rejected


def test_curation_job_writes_both_outputs(spark, tmp_path):
    changes = [{}, {"price": "300"}, {"symbol": " "}, {"market_timestamp": "2025-03-03"}]
    result, out, rejected = curation(spark, tmp_path, *changes)
    assert result.curated_written and result.rejected_written
    run = "run_id=20250306T080000Z"
    assert folders(out) == {f"year=2025/month=03/day=03/{run}", f"year=2025/month=03/day=04/{run}"}
    assert folders(rejected) == {f"year=2025/month=03/day=06/{run}"}
    assert all(".snappy." in f.name for f in Path(out).rglob("part-*.parquet"))
    assert sorted(r["price"] for r in files.scan_curated(spark, out).collect()) == [64.25, 300.0]
    row = files.scan_rejected(spark, rejected).first()
    assert row["rejection_reason"] == "MISSING_SYMBOL"
    assert row["source_file"].startswith("file:") and row["month"] == "03"


def test_curation_job_run_twice_leaves_one_copy(spark, tmp_path):
    changes = [{}, {"price": "300"}, {"symbol": " "}, {"market_timestamp": "2025-03-03"}]
    _, out, rejected = curation(spark, tmp_path, *changes)
    again = curate(spark, str(tmp_path / "standardized"), out, rejected, datetime(2025, 3, 6, 8))
    assert again.curated_written and again.rejected_written
    assert files.scan_curated(spark, out).count() == 2
    assert files.scan_rejected(spark, rejected).count() == 1
    curate(spark, str(tmp_path / "standardized"), out, rejected, datetime(2025, 3, 6, 9))
    assert files.scan_curated(spark, out).count() == 4
    catalog.register_table(spark, "run_zone", out, CURATED_RUNS, partitions=RUN_PARTITIONS)
    try:
        assert spark.table("run_zone").count() == 4
    finally:
        spark.sql("DROP TABLE run_zone")


def counting(spark, rows):
    """The rows with a counter of how often one of them is read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(count, rows.schema), seen


@pytest.mark.parametrize("job", ["curate", "ingest"])
def test_jobs_read_their_source_once(spark, tmp_path, job):
    if job == "curate":
        changes = [{"symbol": f"S{i}", "price": "0" if i % 5 == 0 else "7"} for i in range(50)]
        rows, seen = counting(spark, standardized(spark, *changes))
        out, rejected = str(tmp_path / "curated"), str(tmp_path / "rejected")
        curate(spark, rows, out, rejected, RUN_TIME)
        assert files.scan_curated(spark, out).count() == 40
        assert files.scan_rejected(spark, rejected).count() == 10
    else:
        texts = [response(symbol=f"S{i}", close="x" if i % 5 == 0 else "64.25") for i in range(50)]
        rows, seen = counting(spark, responses(spark, *texts).drop("run_timestamp"))
        raw, standard = str(tmp_path / "raw"), str(tmp_path / "standard")
        result = run_ingestion(
            rows, RUN_TIME, lambda f: files.write_raw(f, raw) or raw, lambda f: files.write_standardized(f, standard) or standard
        )
        assert result.failures.count() == 10 and result.successful_count == 40
        assert Path(result.stored_run.removeprefix("file:")).exists()
        result.close()
        assert not Path(result.stored_run.removeprefix("file:")).exists()
    assert seen.value == 50


def test_jobs_leave_the_sessions_sizes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quotewright.session.PARTITION_BYTES", 10)
    spark.conf.set(INITIAL_PARTITIONS, "7")
    try:
        curate(spark, standardized(spark, {}), str(tmp_path / "c"), str(tmp_path / "r"), RUN_TIME)
        assert spark.conf.get(INITIAL_PARTITIONS) == "7"
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_curation_job_skips_empty_outputs(spark, tmp_path):
    result, out, rejected = curation(spark, tmp_path, {})
    assert (result.curated_written, result.rejected_written) == (True, False)
    assert Path(out).exists() and not Path(rejected).exists()


def test_curation_job_with_nothing_valid(spark, tmp_path):
    result, out, rejected = curation(spark, tmp_path, {"price": "0"})
    assert (result.curated_written, result.rejected_written) == (False, True)
    assert not Path(out).exists() and Path(rejected).exists()


def test_curation_job_with_nothing_at_all(spark, tmp_path):
    empty = standardized(spark, {}).limit(0)
    out, rejected = str(tmp_path / "curated"), str(tmp_path / "rejected")
    result = curate(spark, empty, out, rejected, RUN_TIME)
    assert (result.curated_written, result.rejected_written) == (False, False)
    assert not Path(out).exists() and not Path(rejected).exists()


def test_a_broken_line_is_rejected_not_lost(spark, tmp_path):
    source = tmp_path / "standardized"
    source.mkdir()
    (source / "a.json").write_text("{broken\n", encoding="utf-8")
    rejected = str(tmp_path / "rejected")
    curate(spark, str(source), str(tmp_path / "curated"), rejected, RUN_TIME)
    assert files.scan_rejected(spark, rejected).first()["rejection_reason"] == "MISSING_SYMBOL"


def test_replay_of_the_raw_zone(spark, tmp_path):
    path = str(tmp_path / "raw")
    files.write_raw(responses(spark, response(), response(symbol="jpm"), "not json"), path)
    again = replay(files.replayable(files.scan_raw(spark, path)))
    rows = again.orderBy("symbol").collect()
    assert [r["symbol"] for r in rows] == ["JPM", "NQRA"]
    assert rows[0]["ingestion_timestamp"] == RUN_TIME


def test_tables_find_new_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "curated")
    files.write_curated(quotes(spark, quote()), path)
    catalog.register_table(spark, "curated_zone", path, CURATED)
    try:
        assert spark.table("curated_zone").count() == 1
        files.write_curated(quotes(spark, quote(at="2025-08-01 10:00:00")), path)
        catalog.register_table(spark, "curated_zone", path, CURATED)
        table = spark.table("curated_zone")
        assert {r["month"] for r in table.collect()} == {"03", "08"}
        wider = StructType([*CURATED.fields, StructField("note", StringType())])
        assert catalog.add_columns(spark, "curated_zone", wider) == ["note"]
        assert spark.table("curated_zone").filter("note is null").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS curated_zone")


def test_standardized_zone_as_a_table(spark, tmp_path):
    path = str(tmp_path / "standardized")
    files.write_standardized(st.standardized_zone(st.ingest(responses(spark, response()))), path)
    partitions = ["year", "month", "day", "run_id"]
    fields = [StructField(n, StringType()) for n in partitions]
    schema = StructType([*STANDARDIZED.fields, *fields])
    catalog.register_table(spark, "standardized_zone", path, schema, "json", partitions)
    try:
        row = spark.table("standardized_zone").first()
        assert (row["symbol"], row["day"], row["run_id"]) == ("NQRA", "05", "20250305T142005Z")
        out = str(tmp_path / "curated")
        curate(spark, spark.table("standardized_zone"), out, str(tmp_path / "r"), RUN_TIME)
        assert files.scan_curated(spark, out).count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS standardized_zone")


def test_sql_text_on_the_view(spark, curated):
    catalog.register_view(curated)
    rows = spark.sql(
        "SELECT symbol, timestampdiff(MINUTE, max(market_timestamp), max(ingestion_timestamp)) m "
        "FROM curated_quotes GROUP BY symbol ORDER BY symbol"
    ).collect()
    assert rows and all(r["m"] >= 0 for r in rows)


def test_results_as_csv(spark, tmp_path):
    path = str(tmp_path / "results")
    files.write_result(spark.range(3), path)
    assert spark.read.option("header", True).csv(path).count() == 3


def test_reports_by_name(spark, curated, tmp_path):
    folders = write_reports(curated, str(tmp_path), ["gainers", "dq_scorecard", "dq_price"])
    read = {n: spark.read.option("header", True).csv(f) for n, f in folders.items()}
    assert read["gainers"].count() <= 10 and "change_percent" in read["gainers"].columns
    assert read["dq_scorecard"].first()["invalid_price_rows"] == "0"
    assert read["dq_price"].count() == 0


def test_partition_strings_need_no_session_setting(spark, tmp_path):
    path = str(tmp_path / "curated")
    files.write_curated(quotes(spark, quote()), path)
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(name, "true")
    try:
        row = files.scan_curated(spark, path).first()
    finally:
        spark.conf.set(name, "false")
    assert (row["month"], row["day"]) == ("03", "04")


def test_symbol_lists(spark):
    default = files.requested_symbols(spark).orderBy("position").collect()
    assert tuple(r["symbol"] for r in default) == DEFAULT_WATCHLIST
    given = files.requested_symbols(spark, [" nqra ", "amzn", "", "JPM", "JPM"])
    assert [r["symbol"] for r in given.orderBy("position").collect()] == [
        "NQRA",
        "AMZN",
        "JPM",
        "JPM",
    ]
    with pytest.raises(ValueError, match="must be a list"):
        files.requested_symbols(spark, "NQRA")
    with pytest.raises(ValueError, match="at least one"):
        files.requested_symbols(spark, ["", "   "])


def test_shuffles_are_sized_by_the_input(spark):
    spark.conf.unset(INITIAL_PARTITIONS)
    configure(spark)
    assert spark.conf.get(INITIAL_PARTITIONS) == "4"
    try:
        configure(spark, input_bytes=10**14)
        assert spark.conf.get(INITIAL_PARTITIONS) == str(-(-(10**14) // PARTITION_BYTES))
        configure(spark)
        assert spark.conf.get(INITIAL_PARTITIONS) == str(-(-(10**14) // PARTITION_BYTES))
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


@pytest.mark.parametrize("job", ["curate", "replay", "incremental"])
def test_jobs_size_their_shuffles(spark, tmp_path, monkeypatch, job):
    monkeypatch.setattr("quotewright.session.PARTITION_BYTES", 500)
    zones = {name: str(tmp_path / name) for name in ("source", "raw", "out", "rejected", "log", "checkpoint")}
    sizes = []
    own = sized

    def watched(rows):
        session = own(rows)
        sizes.append(int(session.conf.get(INITIAL_PARTITIONS)))
        return session

    monkeypatch.setattr("quotewright.plans.jobs.sized", watched)
    monkeypatch.setattr("quotewright.streaming.incremental.sized", watched)
    try:
        for count in (10, 200):
            rows = standardized(spark, *({"symbol": f"S{i}"} for i in range(count)))
            rows.coalesce(1).write.mode("overwrite").json(zones["source"])
            texts = responses(spark, *(response(symbol=f"s{i}") for i in range(count)))
            files.write_raw(texts, zones["raw"])
            if job == "curate":
                curate(spark, zones["source"], zones["out"], zones["rejected"], RUN_TIME)
            elif job == "replay":
                replay_zone(spark, zones["raw"], zones["out"], zones["rejected"], RUN_TIME)
            else:
                run_incremental(spark, *(zones[n] for n in ("source", "out", "rejected", "log", "checkpoint")), RUN_TIME)
        assert 4 < sizes[0] < sizes[-1] / 5
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_indented_responses_stay_one_line(spark, tmp_path):
    path = str(tmp_path / "raw")
    texts = [json.dumps(json.loads(response(symbol=s, name="a\nb")), indent=2) for s in ("a", "b")]
    files.write_raw(st.raw_zone(st.ingest(responses(spark, *texts))), path)
    lines = [r["response"] for r in files.scan_raw(spark, path).collect()]
    assert sorted(json.loads(line)["symbol"] for line in lines) == ["a", "b"]
    again = st.ingest(files.replayable(files.scan_raw(spark, path)))
    assert [r["status"] for r in again.collect()] == ["OK", "OK"]
    assert {r["company_name"] for r in again.collect()} == {"a\nb"}


def test_replay_job_writes_both_zones(spark, tmp_path):
    raw, out, rejected = (str(tmp_path / n) for n in ("raw", "out", "rejected"))
    rows = responses(spark, response(symbol="a"), response(symbol="b", datetime="no date"), "not json")
    files.write_raw(st.raw_zone(st.ingest(rows)), raw)
    result = replay_zone(spark, raw, out, rejected, RUN_TIME)
    assert result.curated_written and result.rejected_written
    assert [r["symbol"] for r in files.scan_curated(spark, out).collect()] == ["A"]
    reasons = [r["rejection_reason"] for r in files.scan_rejected(spark, rejected).collect()]
    assert reasons == ["INVALID_MARKET_TIMESTAMP"]


def test_odd_folders_do_not_stop_a_scan(spark, tmp_path):
    path = tmp_path / "raw"
    for day in ("day=05", "day=xx", "day=31"):
        folder = path / "year=2025" / ("month=06" if day == "day=31" else "month=03") / day
        folder.mkdir(parents=True)
        (folder / "quotes_20250305T142005Z.jsonl").write_text("{}\n")
    rows = files.scan_raw(spark, str(path), first=date(2025, 3, 1), last=date(2025, 3, 31))
    assert rows.filter("source_file LIKE '%day=05%'").count() == 1


def test_curation_of_a_typed_table(spark, tmp_path):
    """A standardized zone read with inferred types, as a catalog has it."""
    source = str(tmp_path / "standardized")
    rows = standardized(spark, {}, {"price": "-1"})
    numbers = {n: F.col(n).cast("double") for n in ("price", "high_price", "low_price")}
    rows.withColumns({**numbers, "volume": F.col("volume").cast("bigint")}).write.json(source)
    out, rejected = str(tmp_path / "curated"), str(tmp_path / "rejected")
    curate(spark, spark.read.json(source), out, rejected, RUN_TIME)
    row = files.scan_curated(spark, out).first()
    assert (row["price"], row["volume"], row["day"]) == (64.25, 731_204, "04")
    row = files.scan_rejected(spark, rejected).first()
    assert row["rejection_reason"] == "INVALID_PRICE" and row["source_file"].endswith(".json")


def test_shared_folder_is_below_the_checkpoint_dir(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark, "x")
    assert folder.startswith(named or spark.sparkContext.getCheckpointDir())
    assert folder.endswith(f"{spark.sparkContext.applicationId}/x")
