"""Missing runs, health windows, retention and rejections."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotewright.operators import operations as op
from quotewright.streaming.health import stream_health
from tests.builders import quote, quotes

SPAN = "symbol string, first_date date, last_date date"


def expected(span):
    """The slots of spans on all days of theirs."""
    days = span.select(F.explode(F.sequence("first_date", "last_date")).alias("day")).distinct()
    return op.expected_slots(span, days)


@pytest.mark.parametrize(
    ("day", "first", "last"),
    [
        # The clock changes between these two.
        (date(2026, 3, 6), datetime(2026, 3, 6, 14, 30), datetime(2026, 3, 6, 21, 0)),
        (date(2026, 3, 9), datetime(2026, 3, 9, 13, 30), datetime(2026, 3, 9, 20, 0)),
        (date(2026, 11, 2), datetime(2026, 11, 2, 14, 30), datetime(2026, 11, 2, 21, 0)),
    ],
)
def test_slots_of_a_day(spark, day, first, last):
    rows = expected(spark.createDataFrame([("A", day, day)], SPAN)).collect()
    slots = sorted(r["slot"] for r in rows)
    assert len(slots) == 79
    assert (slots[0], slots[-1]) == (first, last)


def test_no_slots_at_weekends(spark):
    span = spark.createDataFrame([("A", date(2026, 3, 7), date(2026, 3, 8))], SPAN)
    assert expected(span).isEmpty()


def test_slots_do_not_depend_on_the_session_zone(spark):
    span = spark.createDataFrame([("A", date(2026, 3, 9), date(2026, 3, 9))], SPAN)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        slots = sorted(r["slot"] for r in expected(span).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert slots[0] == datetime(2026, 3, 9, 13, 30)


def test_missing_slots(spark):
    start = datetime(2026, 3, 9, 13, 30)
    rows = [
        quote("A", start + timedelta(minutes=5 * i, seconds=40)) for i in range(79) if i not in (3, 7)
    ]
    rows += [quote("A", start), quote("B", datetime(2026, 3, 9, 2, 0))]
    missing = op.missing_slots(quotes(spark, *rows)).collect()
    of_a = sorted(r["slot"] for r in missing if r["symbol"] == "A")
    assert of_a == [start + timedelta(minutes=15), start + timedelta(minutes=35)]
    assert sum(r["symbol"] == "B" for r in missing) == 79


def test_slots_of_given_days_and_of_a_far_date(spark):
    rows = [quote("A", datetime(2026, 3, 9, 13, 30)), quote("A", datetime(9999, 3, 9, 13, 30))]
    frame = quotes(spark, *rows)
    slots = op.missing_slots(frame).collect()
    # 13:30 UTC is no slot of the far day: its clock is an hour on by then.
    assert len(slots) == 2 * 79 - 1
    slots = op.missing_slots(frame, date(2026, 3, 9), date(2026, 3, 20)).collect()
    assert len(slots) == 79 - 1


MEASURES = "ts timestamp_ntz, errors bigint, throttles bigint, ms double"


def test_health_windows(spark):
    t = datetime(2026, 3, 9, 13, 0)
    rows = [
        (t, 0, 0, 100.0),
        (t + timedelta(minutes=4, seconds=59), 1, 0, 24_999.0),
        (t + timedelta(minutes=5), 0, 1, 25_000.0),
        (t + timedelta(minutes=15), 0, None, None),
    ]
    frame = spark.createDataFrame(rows, MEASURES)
    result = op.health_windows(frame, "ts", F.col("errors"), F.col("throttles"), F.col("ms"))
    result = result.orderBy("window_start").collect()
    alarms = [(r["error_alarm"], r["throttle_alarm"], r["duration_alarm"]) for r in result]
    assert alarms == [(True, False, False), (False, True, True), (False, False, False)]
    assert result[0]["errors"] == 1 and result[0]["max_duration_ms"] == 24_999.0
    assert result[1]["window_end"] == t + timedelta(minutes=10)


def test_health_stream_gives_closed_windows(spark, tmp_path):
    t = datetime(2026, 3, 9, 13, 0)
    source = str(tmp_path / "measures")

    def arrive(*rows):
        spark.createDataFrame(list(rows), MEASURES).coalesce(1).write.mode("append").json(source)

    columns = ("ts", F.col("errors"), F.col("throttles"), F.col("ms"))
    arrive((t, 1, 0, 100.0))
    stream = spark.readStream.schema(MEASURES).json(source)
    query = (
        stream_health(stream, *columns)
        .writeStream.format("memory")
        .queryName("health")
        .outputMode("append")
        .start()
    )
    try:
        query.processAllAvailable()
        arrive((t + timedelta(minutes=1), 0, 0, 30_000.0))
        query.processAllAvailable()
        arrive((t + timedelta(hours=1), 0, 0, 1.0))
        query.processAllAvailable()
        # Too late: its window is closed.
        arrive((t + timedelta(minutes=2), 5, 5, 5.0))
        query.processAllAvailable()
        rows = spark.table("health").collect()
    finally:
        query.stop()
    assert [(r["window_start"], r["errors"], r["max_duration_ms"]) for r in rows] == [
        (t, 1, 30_000.0)
    ]
    assert rows[0]["error_alarm"] and rows[0]["duration_alarm"]


def test_retention(spark):
    as_of = date(2025, 3, 4)
    ages = {"raw": 90, "standardized": 365, "rejected": 90, "results": 30}
    rows = []
    for zone, days in {**ages, "curated": 5000}.items():
        for age in (days, days + 1):
            day = as_of - timedelta(days=age)
            rows.append((zone, f"{day:%Y}", f"{day:%m}", f"{day:%d}"))
    rows.append(("raw", "__HIVE_DEFAULT_PARTITION__", "01", "01"))
    frame = spark.createDataFrame(rows, "zone string, year string, month string, day string")
    expired = op.expired_partitions(frame, as_of).collect()
    assert sorted(r["zone"] for r in expired) == sorted(ages)
    assert op.kept_partitions(frame, as_of).count() == len(rows) - len(ages)


def test_rejected_report(spark):
    rows = [("INVALID_PRICE", datetime(2025, 3, 4, 23), s) for s in ("A", "A", None)]
    frame = spark.createDataFrame(
        rows, "rejection_reason string, rejected_at timestamp_ntz, symbol string"
    )
    result = [tuple(r) for r in op.rejected_report(frame).collect()]
    day = date(2025, 3, 4)
    assert result == [("INVALID_PRICE", day, "A", 2), ("INVALID_PRICE", day, None, 1)]


def test_quotes_of_a_universe(spark):
    frame = quotes(spark, quote("A"), quote("B"), quote("C"))
    universe = spark.createDataFrame([("A",), ("C",), ("C",), ("X",)], "symbol string")
    found = op.restrict_to(frame, universe)
    assert sorted(r["symbol"] for r in found.collect()) == ["A", "C"]
