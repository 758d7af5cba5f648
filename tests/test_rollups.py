"""Rollups by day give what the reports give over all quotes."""

import random
import statistics
from datetime import date, datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quotewright.operators import analytics, check_states, quality, rollups
from quotewright.plans.rollups import TABLES, on_days, refresh, scan_rollup
from quotewright.sources import files
from tests.builders import plan_of, quote, quotes

START = datetime(2025, 3, 3, 10)


def same(left, right):
    assert left.columns == right.columns
    assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def random_rows(seed, count=120):
    """Quotes with repeated keys, missing parts and rows in wrong partitions."""
    pick = random.Random(seed)
    rows = []
    for _ in range(count):
        at = START + timedelta(days=pick.randrange(4), minutes=pick.randrange(6))
        if pick.random() < 0.05:
            at = None
        changes = {"ingestion_timestamp": START + timedelta(days=5, seconds=pick.randrange(9**6))}
        changes["price"] = pick.choice([None, -1.0, round(pick.uniform(1, 90), 2)])
        changes["change_percent"] = pick.choice([None, 0.0, round(pick.uniform(-9, 9), 4)])
        changes["volume"] = pick.choice([None, -3, 10])
        if pick.random() < 0.1:
            changes["day"] = pick.choice([None, "04", "99"])
        symbol = pick.choice(["A", "B", " c", None]) if pick.random() < 0.5 else "A"
        company = pick.choice(["Left", "Right", None])
        rows.append(quote(symbol, at, company_name=company, **changes))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_states_give_the_checks_of_all_rows(spark, seed):
    rows = quotes(spark, *random_rows(seed))
    states, strays = check_states.check_states(rows), check_states.stray_keys(rows)
    same(check_states.null_profile_of(states), quality.null_profile(rows))
    same(check_states.scorecard_of(states), quality.scorecard(rows))
    same(check_states.report_of(states, strays, rows), quality.report(rows))


def test_a_key_at_home_and_astray_counts_once(spark):
    at = "2025-03-04 10:00:00"
    rows = quotes(spark, quote("A", at), quote("A", at, day="05"), quote("B", at), quote("B", at))
    states, strays = check_states.check_states(rows), check_states.stray_keys(rows)
    found = {r["check"]: r["failures"] for r in check_states.report_of(states, strays, rows).collect()}
    assert (found["dq_dup_keys"], found["dq_dup_rows"]) == (2, 4)
    assert strays.count() == 1


def test_no_rows(spark):
    rows = quotes(spark).limit(0)
    states, strays = check_states.check_states(rows), check_states.stray_keys(rows)
    same(check_states.null_profile_of(states), quality.null_profile(rows))
    same(check_states.scorecard_of(states), quality.scorecard(rows))
    same(check_states.report_of(states, strays, rows), quality.report(rows))
    assert rollups.volatility_of(rollups.daily_moments(rows)).isEmpty()
    assert rollups.daily_latest(rows).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_volatility_of_days(spark, seed):
    rows = quotes(spark, *random_rows(seed))
    moments = rollups.daily_moments(rows)
    same(rollups.volatility_of(moments), analytics.volatility(rows))
    first, last = date(2025, 3, 4), date(2025, 3, 5)
    some = analytics.quotes_between(moments, first, last)
    same(rollups.volatility_of(some), analytics.volatility(analytics.quotes_between(rows, first, last)))


@pytest.mark.parametrize(
    ("level", "spread", "tolerance"), [(50.0, 10.0, 1e-12), (1e6, 0.5, 1e-9), (1e9, 1.0, 1e-6)]
)
def test_deviation_of_many_days(spark, level, spread, tolerance):
    """A double holds a mean of 1e9 to 1e-7 only, and the deviation no better."""
    pick = random.Random(5)
    prices = [level + pick.uniform(-spread, spread) for _ in range(900)]
    rows = quotes(
        spark,
        *(quote("A", START + timedelta(days=i % 30, minutes=i), price=p) for i, p in enumerate(prices)),
    )
    merged = rollups.daily_moments(rows).groupBy("symbol").agg(rollups.merged_moments("price").alias("m"))
    moments = merged.select("m.*").first()
    assert moments["count"] == 900
    exact = float(statistics.variance(map(Fraction, prices)))
    assert moments["squares"] / 899 == pytest.approx(exact, rel=tolerance)


def test_reports_on_newest_quotes(spark, curated):
    latest = rollups.daily_latest(curated)
    same(analytics.latest_quote(latest), analytics.latest_quote(curated))
    same(analytics.market_breadth(latest), analytics.market_breadth(curated))
    same(analytics.day_over_day(latest), analytics.day_over_day(curated))
    same(rollups.freshness_of(latest), analytics.freshness(curated))


def test_newest_quotes_of_two_tables(spark, curated):
    parts = [curated.filter(F.crc32("symbol") % 2 == i) for i in (0, 1)]
    late = F.crc32(F.col("market_timestamp").cast("string").cast("binary")) % 3 == 0
    for left, right in [parts, [curated.filter(late), curated.filter(~late)]]:
        merged = rollups.merged_latest(rollups.daily_latest(left), rollups.daily_latest(right))
        same(merged, rollups.daily_latest(curated))


def test_the_latest_ingest_need_not_be_that_of_the_newest_quote(spark):
    rows = quotes(
        spark,
        quote("A", "2025-03-04 10:00:00", ingestion_timestamp=datetime(2025, 3, 9)),
        quote("A", "2025-03-04 11:00:00", ingestion_timestamp=datetime(2025, 3, 5)),
    )
    same(rollups.freshness_of(rollups.daily_latest(rows)), analytics.freshness(rows))


def test_refresh_of_touched_days(spark, tmp_path):
    table, path = str(tmp_path / "quotes"), str(tmp_path / "rollups")
    files.write_curated(quotes(spark, *(quote("A", f"2025-03-0{d} 10:00:00") for d in (3, 4, 5))), table)
    refresh(files.scan_curated(spark, table), path)
    # One day changes, one comes anew, one loses all its rows.
    new = [quote("A", "2025-03-04 10:00:00", price=50.0), quote("B", "2025-03-06 10:00:00")]
    files.write_curated(quotes(spark, *new), table, mode="overwrite")
    rows = files.scan_curated(spark, table).filter(F.col("day") != "05")
    for _ in range(2):
        refresh(rows, path, [date(2025, 3, d) for d in (4, 5, 6)])
        for name, work_out in TABLES.items():
            same(scan_rollup(spark, path, name), work_out(rows))


def test_refresh_reads_the_touched_day_only(spark, curated):
    plan = plan_of(check_states.check_states(on_days(curated, [date(2024, 1, 8)])))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-08" in filters
    scan = on_days(curated, [date(2024, 1, 8)])
    assert {r["day"] for r in scan.select("day").distinct().collect()} <= {"08"}


def test_reports_from_rollups_read_no_quotes(spark, curated, tmp_path):
    path = str(tmp_path / "rollups")
    refresh(curated, path)
    moments, states = scan_rollup(spark, path, "moments"), scan_rollup(spark, path, "check_states")
    for report in (rollups.volatility_of(moments), check_states.scorecard_of(states)):
        assert "/curated" not in plan_of(report)
        assert not report.isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_moving_average_of_some_days(spark, seed):
    """Symbols with gaps of days, ties and days of fewer rows than a tail has."""
    pick = random.Random(seed)
    rows = []
    for symbol, share in (("A", 0.9), ("B", 0.3), ("C", 0.05)):
        for minute in range(0, 9 * 24 * 60, 97):
            if pick.random() < share:
                at = START + timedelta(minutes=minute)
                price = pick.choice([None, round(pick.uniform(1, 90), 2)])
                rows.append(quote(symbol, at, price=price))
    table = quotes(spark, *rows)
    tails = rollups.daily_tails(table)
    whole = analytics.moving_avg_7(table)
    for first, last in ((3, 3), (4, 4), (6, 9), (12, 12), (3, 12)):
        dates = date(2025, 3, first), date(2025, 3, last)
        within = whole.filter(F.to_date("market_timestamp").between(*map(F.lit, dates)))
        same(rollups.moving_avg_between(table, tails, *dates), within)


def test_carried_rows_get_no_mean_in_crowded_days(spark):
    times = [START + timedelta(seconds=7 * i) for i in range(200)]
    table = quotes(spark, *(quote("A", at, price=float(i)) for i, at in enumerate(times)))
    old = table.filter("price < 100")
    carry = rollups.daily_tails(old)
    assert carry.count() == rollups.TAIL_ROWS
    found = analytics.moving_average(table.filter("price >= 100"), day_rows=20, carry=carry)
    whole = analytics.moving_average(table).filter("price >= 100")
    same(found.select(whole.columns), whole)


def test_moving_average_of_a_day_reads_tails_before_it(spark, curated, tmp_path):
    path = str(tmp_path / "rollups")
    refresh(curated, path, names=["tails"])
    day = date(2024, 1, 9)
    means = rollups.moving_avg_between(curated, scan_rollup(spark, path, "tails"), day, day)
    plan = plan_of(means)
    assert plan.count("20240109") >= 3 and "WindowGroupLimit" in plan
    within = analytics.moving_avg_7(curated).filter(F.to_date("market_timestamp") == F.lit(day))
    same(means, within)
