"""Symbol sets by day count what the reports count over all quotes."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotewright.operators import analytics, quality, symbol_sets
from quotewright.plans.rollups import refresh_symbol_sets, scan_numbers, scan_symbol_sets
from tests.builders import plan_of, quote, quotes

START = datetime(2025, 3, 3, 10)


def same(left, right):
    assert left.columns == right.columns
    assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def random_rows(seed, count=150, symbols=40):
    """Quotes with missing parts and partitions that are no date."""
    pick = random.Random(seed)
    rows = []
    for _ in range(count):
        at = START + timedelta(days=pick.randrange(4), minutes=pick.randrange(300))
        changes = {
            "exchange": pick.choice(["NYSE", "NASDAQ", None]),
            "price": pick.choice([None, round(pick.uniform(1, 90), 2)]),
            "change_percent": pick.choice([None, 0.0, round(pick.uniform(-9, 9), 4)]),
            "volume": pick.choice([None, 10, 2**40]),
        }
        if pick.random() < 0.1:
            changes["day"] = pick.choice([None, "99"])
        symbol = pick.choice([None, "HOT", "HOT", f"S{pick.randrange(symbols)}"])
        rows.append(quote(symbol, at, **changes))
    return rows


def numbered(rows):
    none = rows.sparkSession.createDataFrame([], symbol_sets.NUMBERS)
    return symbol_sets.new_numbers(none, rows)


@pytest.mark.parametrize("seed", range(2))
def test_reports_from_sets(spark, seed):
    rows = quotes(spark, *random_rows(seed))
    sets = symbol_sets.daily_sets(rows, numbered(rows))
    same(symbol_sets.exchange_summary_of(sets), analytics.exchange_summary(rows))
    same(symbol_sets.partition_summary_of(sets), analytics.partition_summary(rows))
    counts = symbol_sets.partition_summary_of(sets, "distinct_symbol_count")
    same(counts, quality.partition_counts(rows))
    some = (date(2025, 3, 4), date(2025, 3, 5))
    same(
        symbol_sets.exchange_summary_of(analytics.quotes_between(sets, *some)),
        analytics.exchange_summary(analytics.quotes_between(rows, *some)),
    )


def test_values_without_an_exact_form(spark):
    rows = quotes(spark, quote("A", price=1e300), quote("B", price=2.0), quote("C", price=None))
    sets = symbol_sets.daily_sets(rows, numbered(rows))
    same(symbol_sets.exchange_summary_of(sets), analytics.exchange_summary(rows))


def test_no_rows(spark):
    rows = quotes(spark).limit(0)
    sets = symbol_sets.daily_sets(rows, numbered(rows))
    assert symbol_sets.exchange_summary_of(sets).isEmpty()
    assert symbol_sets.partition_summary_of(sets).isEmpty()


def test_numbers_have_no_gaps_and_are_kept(spark):
    rows = quotes(spark, *(quote(f"S{i % 700}") for i in range(900)), quote(None))
    first = numbered(rows)
    given = {r["symbol"]: r["number"] for r in first.collect()}
    assert sorted(given.values()) == list(range(1, 701))
    same(first, numbered(rows.repartition(3)))
    more = quotes(spark, *(quote(f"S{i}") for i in range(650, 800)))
    new = {r["symbol"]: r["number"] for r in symbol_sets.new_numbers(first, more).collect()}
    assert set(new) == {f"S{i}" for i in range(700, 800)}
    assert sorted(new.values()) == list(range(701, 801))


def test_numbers_of_several_blocks(spark):
    """Two exchanges share a third of more symbols than a bitmap holds."""
    ids = spark.range(50_000)
    numbers = ids.select(F.concat(F.lit("S"), "id").alias("symbol"), (F.col("id") + 1).alias("number"))
    base = quotes(spark, quote("X")).drop("symbol", "exchange")
    both = base.crossJoin(numbers.select("symbol", "number"))
    left = both.filter("number <= 33000").withColumn("exchange", F.lit("LEFT"))
    right = both.filter("number > 20000").withColumn("exchange", F.lit("RIGHT"))
    rows = left.unionByName(right).drop("number")
    sets = symbol_sets.daily_sets(rows, numbers)
    found = {r["exchange"]: r["symbol_count"] for r in symbol_sets.exchange_summary_of(sets).collect()}
    assert found == {"LEFT": 33_000, "RIGHT": 30_000}
    assert symbol_sets.partition_summary_of(sets).first()["symbol_count"] == 50_000


def test_a_symbol_without_a_number_is_an_error(spark):
    rows = quotes(spark, quote("A"), quote("B"))
    known = numbered(rows.filter("symbol = 'A'"))
    with pytest.raises(PySparkException, match="symbol without a number"):
        symbol_sets.daily_sets(rows, known).collect()


def test_refresh_of_touched_days(spark, tmp_path):
    path = str(tmp_path)
    rows = quotes(spark, *random_rows(7)).filter("day <> '99'")
    refresh_symbol_sets(rows.filter("day <> '05'"), path)
    before = {r["symbol"]: r["number"] for r in scan_numbers(spark, path).collect()}
    # A day comes anew, one loses its rows, one is the same; the run is made twice.
    now = rows.filter("day <> '04'").unionByName(quotes(spark, quote("NEW", "2025-03-05 10:00:00")))
    for _ in range(2):
        refresh_symbol_sets(now, path, [date(2025, 3, d) for d in (4, 5, 6)])
        sets = scan_symbol_sets(spark, path)
        same(symbol_sets.exchange_summary_of(sets), analytics.exchange_summary(now))
        same(symbol_sets.partition_summary_of(sets), analytics.partition_summary(now))
    after = {r["symbol"]: r["number"] for r in scan_numbers(spark, path).collect()}
    assert before.items() <= after.items() and "NEW" in after
    assert len(set(after.values())) == len(after) == scan_numbers(spark, path).count()


def test_reports_shuffle_no_symbols(spark, tmp_path):
    path = str(tmp_path)
    refresh_symbol_sets(quotes(spark, *random_rows(1)).filter("day <> '99'"), path)
    report = symbol_sets.exchange_summary_of(scan_symbol_sets(spark, path))
    plan = plan_of(report)
    assert "symbol_numbers" not in plan and "hashpartitioning(symbol#" not in plan
    assert "bitmap_or_agg" in plan
