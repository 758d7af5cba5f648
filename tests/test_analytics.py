"""Reports: small cases, and brute force over random quotes."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest

from quotewright.operators import analytics as an
from tests.builders import plan_of, quote, quotes


def random_quotes(spark, seed, symbols=5, hot=400, days=4):
    """Quotes with a hot symbol, bursts within a minute, gaps and missing prices."""
    rng = random.Random(seed)
    start = datetime(2026, 3, 1)
    rows, seen = [], set()
    for i in range(symbols):
        for _ in range(hot if i == 0 else rng.randrange(1, 30)):
            burst = rng.random() < 0.5
            at = start + timedelta(
                days=rng.randrange(days),
                minutes=rng.randrange(3) if burst else rng.randrange(1440),
                microseconds=rng.randrange(60_000_000),
            )
            if (i, at) in seen:
                continue
            seen.add((i, at))
            price = None if rng.random() < 0.1 else round(rng.uniform(1, 500), 2)
            change = rng.choice([None, 0.0, round(rng.uniform(-5, 5), 2)])
            rows.append(quote(f"S{i}", at, price=price, change_percent=change))
    return quotes(spark, *rows).repartition(3)


def by_symbol(frame):
    groups = defaultdict(list)
    for row in frame.collect():
        groups[row["symbol"]].append(row)
    for rows in groups.values():
        rows.sort(key=lambda r: r["market_timestamp"])
    return groups


@pytest.mark.parametrize("day_rows", [1, 20, 10**9])
@pytest.mark.parametrize("observations", [1, 2, 7])
def test_moving_average_against_brute_force(spark, day_rows, observations):
    frame = random_quotes(spark, 1)
    expected = {}
    for symbol, rows in by_symbol(frame).items():
        for i, row in enumerate(rows):
            known = [
                r["price"]
                for r in rows[max(0, i - observations + 1) : i + 1]
                if r["price"] is not None
            ]
            mean = sum(known) / len(known) if known else None
            expected[symbol, row["market_timestamp"]] = mean
    result = an.moving_average(frame, observations, day_rows).collect()
    assert len(result) == len(expected)
    for row in result:
        want = expected[row["symbol"], row["market_timestamp"]]
        assert (row["_mean"] is None) == (want is None)
        assert want is None or row["_mean"] == pytest.approx(want, rel=1e-12)


def test_crowded_days_are_cut_into_minutes(spark):
    frame = random_quotes(spark, 1)
    few = plan_of(an.moving_average(frame))
    assert "date_trunc(day" in few and "date_trunc(minute" not in few
    many = plan_of(an.moving_average(frame, day_rows=20))
    assert "date_trunc(minute" in many and "BroadcastHashJoin" in many


def test_latest_quote_of_each_symbol(spark):
    frame = random_quotes(spark, 2)
    expected = {s: rows[-1]["market_timestamp"] for s, rows in by_symbol(frame).items()}
    result = an.latest_quote(frame).collect()
    assert [r["symbol"] for r in result] == sorted(expected)
    assert {r["symbol"]: r["market_timestamp"] for r in result} == expected


def test_top_lists(spark):
    changes = {"A": 3.0, "B": -2.0, "C": 3.0, "D": 0.0, "E": None, "F": 7.5, "G": -9.0}
    rows = [quote(s, change_percent=p, volume=v) for v, (s, p) in enumerate(changes.items())]
    rows += [quote("A", "2025-03-03 10:00:00", change_percent=99.0), quote("H", volume=None)]
    frame = quotes(spark, *rows)
    gainers = [r["symbol"] for r in an.gainers(frame).collect()]
    assert gainers == ["F", "A", "C", "H"]
    assert [r["symbol"] for r in an.losers(frame).collect()] == ["G", "B"]
    volumes = [r["symbol"] for r in an.top_volume(frame).collect()]
    assert volumes == ["G", "F", "E", "D", "C", "B", "A", "H"]


def test_price_range(spark):
    frame = quotes(
        spark,
        quote("A", high_price=110.0, low_price=100.0),
        quote("B", high_price=110.0, low_price=0.0),
        quote("C", high_price=None),
    )
    rows = {r["symbol"]: r for r in an.price_range(frame).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["price_range_percent"] == 10.0
    assert rows["B"]["price_range"] == 110.0 and rows["B"]["price_range_percent"] is None


def test_daily_summary_mean_does_not_depend_on_order(spark):
    rng = random.Random(3)
    base = datetime(2026, 3, 2)
    rows = [
        quote("A", base + timedelta(seconds=i), price=round(rng.uniform(0.01, 9999), 4))
        for i in range(500)
    ]
    outcomes = set()
    for parts in (1, 3, 7):
        rng.shuffle(rows)
        frame = quotes(spark, *rows).repartition(parts)
        outcomes.add(an.daily_summary(frame).first()["average_observed_price"])
    assert len(outcomes) == 1


def test_mean_of_values_without_decimal_form(spark):
    frame = quotes(
        spark,
        quote("A", price=float("nan")),
        quote("B", price=1e300),
        quote("B", "2025-03-04 11:00:00", price=3e300),
        quote("C", price=None),
    )
    means = {r["symbol"]: r["average_observed_price"] for r in an.daily_summary(frame).collect()}
    assert means["A"] != means["A"]
    assert means["B"] == pytest.approx(2e300)
    assert means["C"] is None


def test_market_breadth(spark):
    frame = quotes(
        spark,
        quote("A", "2025-03-04 10:00:00", change_percent=5.0),
        quote("A", "2025-03-04 15:00:00", change_percent=-1.0),
        quote("B", change_percent=0.0),
        quote("C", change_percent=None),
        quote("D", change_percent=2.0),
    )
    row = an.market_breadth(frame).first()
    counts = ("symbol_count", "gaining_symbols", "losing_symbols", "unchanged_symbols")
    assert [row[n] for n in counts] == [4, 1, 1, 1]
    assert row["average_change_percent"] == 0.33


def test_day_over_day_uses_the_last_observed_day(spark):
    frame = quotes(
        spark,
        quote("A", "2025-02-28 10:00:00", price=90.0),
        quote("A", "2025-02-28 16:00:00", price=100.0),
        quote("A", "2025-03-04 10:00:00", price=125.0),
        quote("B", price=1.0),
    )
    rows = an.day_over_day(frame).collect()
    assert len(rows) == 1
    assert rows[0]["market_date"] == date(2025, 3, 4)
    assert rows[0]["day_over_day_change"] == 25.0
    assert rows[0]["day_over_day_change_percent"] == 25.0


def test_volatility_needs_two_rows(spark):
    frame = quotes(
        spark,
        quote("A", price=1.0, change_percent=None),
        quote("A", "2025-03-04 11:00:00", price=3.0, change_percent=None),
        quote("B"),
    )
    rows = an.volatility(frame).collect()
    assert [r["symbol"] for r in rows] == ["A"]
    assert rows[0]["price_standard_deviation"] == 1.41
    assert rows[0]["change_percent_standard_deviation"] is None


def test_freshness_counts_whole_minutes(spark):
    frame = quotes(
        spark, quote("A", ingestion_timestamp=datetime(2025, 3, 4, 10, 1, 59))
    )
    assert an.freshness(frame).first()["market_to_ingestion_delay_minutes"] == 1


def test_a_date_range_reads_its_partitions_only(spark, curated):
    frame = an.quotes_between(curated, date(2024, 1, 8), date(2024, 1, 9))
    assert {r["day"] for r in frame.select("day").distinct().collect()} == {"08", "09"}
    filters = plan_of(frame).split("PartitionFilters: [")[1].split("]")[0]
    assert "20240108" in filters


def test_reports_read_their_columns_only(curated):
    read = plan_of(an.freshness(curated)).split("ReadSchema: ")[1]
    assert "market_timestamp" in read and "price" not in read


@pytest.mark.parametrize(
    "report", [an.preview, an.latest_quote, an.daily_summary, an.moving_avg_7, an.day_over_day]
)
def test_reports_on_an_empty_table(spark, report):
    assert report(quotes(spark)).isEmpty()


def test_nan_neither_leads_nor_gains(spark):
    rows = [quote("A", change_percent=float("nan")), quote("B", change_percent=1.0)]
    frame = quotes(spark, *rows)
    assert [r["symbol"] for r in an.gainers(frame).collect()] == ["B"]
    row = an.market_breadth(frame).first()
    assert (row["gaining_symbols"], row["losing_symbols"], row["unchanged_symbols"]) == (1, 0, 0)


def test_small_prices_keep_their_mean(spark):
    rows = [quote("A", price=1e-10), quote("A", "2025-03-04 11:00:00", price=3e-10)]
    mean = an.daily_summary(quotes(spark, *rows)).first()["average_observed_price"]
    assert abs(mean - 2e-10) < 1e-22


def test_lowest_price_is_rounded_once(spark):
    rows = [quote("A", price=1.00499999996), quote("A", "2025-03-04 11:00:00", price=2.0)]
    assert an.volatility(quotes(spark, *rows)).first()["minimum_price"] == 1.0
