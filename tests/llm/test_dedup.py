import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewright.llm import dedup
from quotewright.llm.common import lower_ascii
from tests.compare import difference, oracle_connection
from tests.llm import helpers

NAMES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def expected(rows, normal=lambda text: text):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text or "")].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = True
        for i in ids:
            out[(i, keep, len(ids), i == keep and stays, sha)] += 1
            stays = stays and i != keep
    return out


def found(frame):
    return Counter(tuple(row[name] for name in NAMES) for row in frame.collect())


@pytest.mark.parametrize("count, width", [(1, 1), (1, 1 << 40), (5, 5), (300, 1 << 20), (5000, 1 << 13), (2000, 1 << 34)])
def test_code_round_trip(count, width):
    low = 12345
    values = low + np.sort(np.random.default_rng(3).choice(width, count, replace=False) if width < 1 << 21 else
                           np.unique(np.random.default_rng(3).integers(0, width, count)))
    rice, highs, lows = dedup.golomb_encode(values, low, width)
    assert np.array_equal(dedup.golomb_decode(len(values), rice, highs, lows, low), values)
    if count > 100:
        assert 8 * (len(highs) + len(lows)) < len(values) * (np.log2(width / len(values)) + 2.5)


def test_every_edge_case(spark):
    frame = helpers.documents(spark)
    rows = [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]
    assert found(dedup.exact_duplicates(frame)) == expected(rows)
    lowered = dedup.exact_duplicates(frame, normalise=lower_ascii)
    assert found(lowered) == expected(rows, helpers.lower_ascii)


def test_no_rows(spark):
    assert dedup.exact_duplicates(helpers.empty(spark)).count() == 0


def test_hot_text_over_many_tasks_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(dedup, "ROUND_ROWS", 50)
    rng = random.Random(8)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rng.randrange(900)}" if i % 3 == 1 else f"own {i}") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    assert found(dedup.exact_duplicates(frame)) == expected(rows)


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    """Bytes decide where fingerprints meet by chance."""
    monkeypatch.setattr(dedup.F, "xxhash64", lambda column: (F.length(column) % 2).cast("long"))
    rows = [(i, f"text {i % 7}") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(dedup.exact_duplicates(frame)) == expected(rows)


def test_lone_rows_are_not_grouped_by_text(spark):
    """Texts without a copy pass the filter by chance only."""
    rows = [(i, f"own text {i}") for i in range(4000)] + [(5000, "own text 5"), (5001, "own text 6")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.xxhash64("text"))
    suspects = texts.groupBy("fingerprint").count().filter("count > 1").select("fingerprint")
    meant, alone = dedup._suspected(texts, suspects, 16)
    assert 4 <= meant.count() <= 8 and meant.count() + alone.count() == len(rows)


def test_sql(spark, sample):
    from quotewright.llm import queries

    con = oracle_connection(sample)
    assert difference(queries.op11_exact_dedup(spark, sample), con, queries.OP11_SQL) is None
