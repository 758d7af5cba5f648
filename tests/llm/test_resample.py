import re
import zlib
from collections import Counter

import pytest

from quotewright.llm import resample
from tests.compare import difference, oracle_connection
from tests.llm import helpers


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", helpers.lower_ascii(text or ""))


def buckets(text, order, count):
    own = words(text)
    runs = [" ".join(own[i : i + n]) for n in range(1, order + 1) for i in range(len(own) - n + 1)]
    return Counter(zlib.crc32(run.encode()) % count for run in runs)


def brute(rows, target, order, count, least, percent):
    source = sum((buckets(text, order, count) for _, text in rows), Counter())
    wanted = sum((buckets(text, order, count) for text in target), Counter())
    gain = resample.gains(source, wanted, count)
    out = []
    for doc_id, text in rows:
        own = buckets(text, order, count)
        weight = sum(gain[b] * n for b, n in own.items())
        out.append([doc_id, sum(own.values()), weight, weight + resample.noise(doc_id), None, len(words(text)) >= least])
    some = sorted((row for row in out if row[5]), key=lambda row: (-row[3], row[0] is None, row[0]))
    for rank, row in enumerate(some[: percent * len(some) // 100], 1):
        row[4] = rank
    return Counter(tuple(row[:5]) for row in out)


def found(frame):
    return Counter(map(tuple, frame.select("doc_id", "n_features", "weight", "score", "rank").collect()))


@pytest.mark.parametrize("order", [1, 2, 5])
def test_runs_have_their_own_crc(order):
    texts = ["a bb ccc", "", "x" * 300 + " y " + "é" * 70_000 + " z1 z2", "one", "Ab-cd_0 é\x00\x7f ß"]
    lists = [resample.normalised(text.encode()) for text in texts]
    crcs, counts = resample.PrefixCrc().runs(lists, order)
    expected = []
    for text in texts:
        own = words(text)
        assert own == [word.decode() for word in resample.normalised(text.encode())]
        expected.append([" ".join(own[i : i + n]) for n in range(1, order + 1) for i in range(len(own) - n + 1)])
    assert counts.tolist() == list(map(len, expected))
    assert crcs.tolist() == [zlib.crc32(run.encode()) for runs in expected for run in runs]


def test_every_edge_case(spark, monkeypatch):
    monkeypatch.setattr(resample, "CELL_ROWS", 3)
    frame = helpers.documents(spark)
    target = spark.createDataFrame([("word1 word2 word3 word3",), (None,), ("",), ("é",)], "text string")
    rows = [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]
    for order, count, least, percent in ((1, 10_000, 20, 10), (3, 100_000, 2, 50), (2, 7, 0, 100)):
        result = resample.importance_resample(
            frame, target, order=order, buckets=count, least_words=least, percent=percent
        )
        assert found(result) == brute(rows, [row[0] for row in target.collect()], order, count, least, percent)


def test_no_rows(spark):
    frame = helpers.documents(spark).limit(30)
    none = helpers.empty(spark)
    assert resample.importance_resample(none, frame).count() == 0
    rows = [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]
    assert found(resample.importance_resample(frame, none)) == brute(rows, [], 1, 10_000, 20, 10)


def test_draw_leans_to_the_target(spark):
    rows = [(i, " ".join(f"{'near' if i % 10 == 0 else 'far'}{(i * 7 + j) % 50}" for j in range(40))) for i in range(600)]
    target = spark.createDataFrame([(" ".join(f"near{j}" for j in range(50)),)], "text string")
    result = resample.importance_resample(spark.createDataFrame(rows, "doc_id long, text string"), target)
    drawn = [row["doc_id"] for row in result.filter("rank is not null").collect()]
    assert len(drawn) == 60 and sum(i % 10 == 0 for i in drawn) >= 58


def test_sql(spark, sample):
    from quotewright.llm import queries

    con = oracle_connection(sample)
    assert difference(queries.op12_resample(spark, sample), con, queries.OP12_SQL) is None
