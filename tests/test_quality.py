"""Quality checks: nothing on the curated table, each fault where it is put."""

from datetime import datetime, timedelta

import pytest

from quotewright.functions.skew import join_counted_keys, join_distinct_keys
from quotewright.operators import quality as qu
from tests.builders import plan_of, quote, quotes

CHECKS = {
    "required": qu.required,
    "price": qu.price,
    "volume": qu.volume,
    "high_low": qu.high_low,
    "duplicate_keys": qu.duplicate_keys,
    "duplicate_rows": qu.duplicate_rows,
    "symbol": qu.symbol_normalized,
    "exchange": qu.exchange_normalized,
    "currency": qu.currency_normalized,
    "source": qu.source_normalized,
    "ahead": qu.market_ahead,
    "partition": qu.partition_match,
    "format": qu.partition_format,
    "change": qu.change_consistent,
    "percent": qu.percent_consistent,
}


@pytest.mark.parametrize("name", CHECKS)
def test_curated_table_passes(curated, name):
    assert CHECKS[name](curated).isEmpty()


NOON = datetime(2025, 3, 4, 12)


@pytest.mark.parametrize(
    ("check", "changes"),
    [
        (qu.required, {"symbol": None}),
        (qu.required, {"symbol": "  "}),
        (qu.required, {"price": None}),
        (qu.required, {"ingestion_timestamp": None}),
        (qu.price, {"price": 0.0}),
        (qu.volume, {"volume": -1}),
        (qu.high_low, {"high_price": 1.0, "low_price": 2.0}),
        (qu.price_in_range, {"price": 111.0}),
        (qu.price_in_range, {"price": 89.0}),
        (qu.symbol_normalized, {"symbol": "nqra"}),
        (qu.exchange_normalized, {"exchange": "NASDAQ "}),
        (qu.currency_normalized, {"currency": "usd"}),
        (qu.source_normalized, {"source": "Twelve_Data"}),
        (qu.market_ahead, {"ingestion_timestamp": datetime(2025, 3, 4, 9)}),
        (qu.ingest_delay, {"ingestion_timestamp": datetime(2026, 7, 11, 11)}),
        (qu.partition_match, {"day": "11"}),
        (qu.partition_format, {"month": "7"}),
        (qu.partition_format, {"day": "32"}),
        (qu.partition_format, {"year": None}),
        (qu.change_consistent, {"change": 1.05}),
        (qu.percent_consistent, {"change_percent": 1.1}),
        (qu.ohlc, {"open_price": 111.0}),
        (qu.ohlc, {"low_price": 100.5, "price": 100.0, "open_price": None}),
    ],
)
def test_each_fault_is_found(spark, check, changes):
    frame = quotes(spark, quote("AMZN"), quote(**changes))
    assert check(frame).count() == 1


@pytest.mark.parametrize(
    ("check", "changes"),
    [
        (qu.volume, {"volume": None}),
        (qu.high_low, {"high_price": None}),
        (qu.price_in_range, {"high_price": None, "price": 1.0}),
        (qu.exchange_normalized, {"exchange": None}),
        (qu.change_consistent, {"change": 1.019}),
        (qu.percent_consistent, {"previous_close": 0.0}),
        (qu.ohlc, {"high_price": None, "low_price": None}),
        # 24 hours and 59 minutes are 24 whole hours.
        (qu.ingest_delay, {"ingestion_timestamp": datetime(2025, 3, 5, 10, 59)}),
    ],
)
def test_what_is_no_fault(spark, check, changes):
    assert check(quotes(spark, quote(**changes))).isEmpty()


def test_sums_over_an_empty_table_are_null(spark):
    empty = quotes(spark)
    row = qu.scorecard(empty).first()
    assert row["total_rows"] == 0 and row["invalid_price_rows"] is None
    assert qu.null_profile(empty).first()["price_nulls"] is None
    assert all(r["passed"] for r in qu.report(empty).collect())


def test_report_agrees_with_the_checks(spark, sample):
    from quotewright.sources.sample_tables import faulty_from_events

    frame = faulty_from_events(spark, sample)
    report = {r["check"]: r["failures"] for r in qu.report(frame).collect()}
    assert len(report) == 18 and all(report.values())
    assert report["dq_price"] == qu.price(frame).count()
    assert report["dq_change_pct"] == qu.percent_consistent(frame).count()
    assert report["dq_dup_keys"] == qu.duplicate_keys(frame).count()
    assert report["dq_dup_rows"] == qu.duplicate_rows(frame).count()


def hot_rows(spark):
    """A third of the rows are copies of one, the rest pairs, singles and NULLs."""
    rows = [quote("HOT", NOON)] * 300
    rows += [quote(f"P{i}", NOON + timedelta(minutes=j % 150)) for i in range(2) for j in range(300)]
    rows += [quote(f"S{i}") for i in range(50)]
    rows += [quote(None, NOON)] * 4
    return quotes(spark, *rows).repartition(8)


def expected_duplicates(frame):
    counts: dict = {}
    rows = frame.collect()
    for r in rows:
        key = (r["symbol"], r["market_timestamp"])
        counts[key] = counts.get(key, 0) + 1
    kept = [r for r in rows if counts[r["symbol"], r["market_timestamp"]] > 1 and r["symbol"]]
    return sorted(kept, key=str)


@pytest.mark.parametrize(
    "limits",
    [{}, {"broadcast_rows": 0, "slice_rows": 40}, {"broadcast_rows": 0, "slice_rows": 10**6}],
)
def test_duplicate_rows_by_broadcast_and_in_slices(spark, limits):
    frame = hot_rows(spark)
    assert sorted(qu.duplicate_rows(frame, **limits).collect(), key=str) == expected_duplicates(
        frame
    )


def test_the_way_of_the_join_follows_the_count(spark):
    frame = hot_rows(spark)
    keys = qu.duplicate_keys(frame).dropna()
    on = ["symbol", "market_timestamp"]
    few = join_counted_keys(frame, keys, on, "duplicate_count")
    assert "BroadcastHashJoin" in plan_of(few)
    many = join_counted_keys(
        frame, keys, on, "duplicate_count", broadcast_rows=0, slice_rows=40
    )
    assert "SortMergeJoin" in plan_of(many) and "_slice" in plan_of(many)


def test_a_sort_parts_equal_rows(spark):
    plan = plan_of(qu.duplicate_rows(hot_rows(spark)))
    assert "SPARK_PARTITION_ID" in plan


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 1, "slice_rows": 40}])
def test_semi_join_with_repeated_keys(spark, limits):
    frame = hot_rows(spark)
    keys = spark.createDataFrame([("HOT",), ("HOT",), ("S1",), ("ZZZ",)], "symbol string")
    found = join_distinct_keys(frame, keys, ["symbol"], **limits)
    assert found.columns == frame.columns
    assert found.count() == 301
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_only_hot_keys_are_copied(spark):
    keys = spark.range(1000).selectExpr("concat('S', id) AS symbol")
    frame = spark.range(3000).selectExpr("concat('S', if(id < 2000, 0, id % 1000)) AS symbol")
    found = join_distinct_keys(frame, keys, ["symbol"], broadcast_rows=10, slice_rows=100)
    assert found.count() == 3000
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence(0, (_slices" in tree
    hot = frame.groupBy("symbol").count().filter("count > 100").count()
    assert hot == 1


NAN = float("nan")


@pytest.mark.parametrize("name", ["price", "high_price", "low_price", "change", "change_percent"])
def test_nan_compares_with_nothing(spark, name):
    frame = quotes(spark, quote("A", **{name: NAN}))
    for check in (qu.price, qu.high_low, qu.price_in_range, qu.change_consistent, qu.percent_consistent, qu.ohlc):
        assert check(frame).isEmpty()
    assert qu.scorecard(frame).first()["invalid_high_low_rows"] == 0
    counts = {r["check"]: r["failures"] for r in qu.report(frame).collect()}
    assert not any(counts.values())
