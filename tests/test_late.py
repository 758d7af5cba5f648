"""Windows of a stream and the rows too late for them make up the input."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotewright.operators.operations import health_windows
from quotewright.streaming import late

SCHEMA = "ts timestamp_ntz, errors bigint, throttles bigint, ms double"
MEASURES = late.Measures("ts", "errors", "throttles", "ms")
START = datetime(2026, 3, 9, 13)
LATE_BY = timedelta(minutes=10)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sorted_rows(rows):
    return sorted(map(repr, rows.select(sorted(rows.columns)).collect()))


def batches_of(seed, count=5):
    """Rows some of which come much later than others; one batch may be empty."""
    pick = random.Random(seed)
    batches = [[] for _ in range(count)]
    for minute in range(0, 100, 2):
        at = START + timedelta(minutes=minute) if pick.random() < 0.95 else None
        place = min(count - 1, max(0, minute * count // 100 + pick.choice([0, 0, 0, 1, 2, -1])))
        if place != seed % count:
            batches[place].append((at, pick.choice([0, 1, None]), 1, pick.uniform(0, 30_000)))
    return batches


def by_rule(batches):
    """Late rows, closed and open windows, one row after the other."""
    newest, closed, gone, windows = None, set(), [], {}
    for rows in batches:
        ends = []
        for row in rows:
            if row[0] is None:
                gone.append(row)
                continue
            start = row[0] - timedelta(minutes=row[0].minute % 5)
            if start in closed:
                gone.append(row)
                continue
            windows.setdefault(start, []).append(row)
            ends.append(row[0])
        newest = max([*ends, newest] if newest else ends, default=None)
        # A window nobody has seen yet is over too once the watermark is past it.
        for minute in range(0, 110, 5):
            start = START + timedelta(minutes=minute)
            if newest and start + timedelta(minutes=5) <= newest - LATE_BY:
                closed.add(start)
    return gone, {s for s in windows if s in closed}, {s for s in windows if s not in closed}


@pytest.mark.parametrize("seed", range(3))
def test_windows_and_late_rows_are_the_input(spark, tmp_path, seed):
    base, batches = str(tmp_path / "health"), batches_of(seed)
    for number, rows in enumerate(batches):
        late.take_batch(frame(spark, rows), number, base, MEASURES, LATE_BY)
    everything = frame(spark, [row for rows in batches for row in rows])
    found = late.corrected_windows(spark, base, everything.schema, MEASURES)
    expected = health_windows(everything, "ts", *(F.col(n) for n in ("errors", "throttles", "ms")))
    assert sorted_rows(found) == sorted_rows(expected)
    gone, closed, still_open = by_rule(batches)
    rows = late.scan_late(spark, base, everything.schema).drop(late.BATCH).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, gone)) and gone
    assert {r["window_start"] for r in late.scan_windows(spark, base).collect()} == closed
    shown = late.scan_windows(spark, base, open_too=True)
    assert {r["window_start"] for r in shown.collect()} == closed | still_open
    assert shown.count() == len(closed | still_open)


@pytest.mark.parametrize("step", ["store", "utc_literal", "merged_windows", "_drop_state"])
def test_a_batch_may_fail_at_any_step_and_run_again(spark, tmp_path, monkeypatch, step):
    batches = batches_of(1)
    plain, broken = str(tmp_path / "plain"), str(tmp_path / "broken")
    for number, rows in enumerate(batches):
        late.take_batch(frame(spark, rows), number, plain, MEASURES, LATE_BY)

        def fail(*args):
            raise OSError("executor lost")

        with monkeypatch.context() as patch:
            patch.setattr(late, step, fail)
            try:
                late.take_batch(frame(spark, rows), number, broken, MEASURES, LATE_BY)
            except OSError:
                pass
        late.take_batch(frame(spark, rows), number, broken, MEASURES, LATE_BY)
    schema = frame(spark, []).schema
    for scan in (
        lambda base: late.scan_windows(spark, base),
        lambda base: late.scan_windows(spark, base, open_too=True),
        lambda base: late.scan_late(spark, base, schema),
    ):
        assert sorted_rows(scan(broken)) == sorted_rows(scan(plain))


def test_an_unfinished_batch_is_not_shown(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "health")
    late.take_batch(frame(spark, [(START, 1, 0, 1.0)]), 0, base, MEASURES, LATE_BY)
    rows = frame(spark, [(START + timedelta(hours=1), 2, 0, 1.0), (None, 0, 0, 0.0)])

    def fail(*args):
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(late, "merged_windows", fail)
        with pytest.raises(OSError):
            late.take_batch(rows, 1, base, MEASURES, LATE_BY)
    assert late.scan_late(spark, base, rows.schema).isEmpty()
    assert [r["errors"] for r in late.scan_windows(spark, base, open_too=True).collect()] == [1]


def test_a_stream(spark, tmp_path):
    source, base = str(tmp_path / "source"), str(tmp_path / "health")
    schema = frame(spark, []).schema

    def arrive(*rows):
        frame(spark, list(rows)).coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema(schema).json(source)
        late.run_health(stream, MEASURES, base, str(tmp_path / "checkpoint"), LATE_BY)

    arrive((START, 1, 0, 100.0))
    arrive((START + timedelta(hours=1), 0, 0, 1.0))
    arrive((START + timedelta(minutes=2), 5, 5, 5.0))
    closed = late.scan_windows(spark, base).collect()
    assert [(r["window_start"], r["errors"]) for r in closed] == [(START, 1)]
    assert [(r["errors"], r[late.BATCH]) for r in late.scan_late(spark, base, schema).collect()] == [(5, 2)]
    whole = late.corrected_windows(spark, base, schema, MEASURES)
    assert {(r["window_start"], r["errors"]) for r in whole.collect()} == {
        (START, 6),
        (START + timedelta(hours=1), 0),
    }


def test_nothing_has_come(spark, tmp_path):
    base = str(tmp_path / "health")
    assert late.scan_windows(spark, base, open_too=True).isEmpty()
    late.take_batch(frame(spark, []), 0, base, MEASURES, LATE_BY)
    late.take_batch(frame(spark, [(START, 1, 0, 1.0)]), 1, base, MEASURES, LATE_BY)
    assert late.scan_windows(spark, base, open_too=True).count() == 1
