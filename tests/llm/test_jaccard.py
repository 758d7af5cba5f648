from collections import Counter
from itertools import combinations

import pytest

from quotewright.llm import jaccard
from quotewright.llm.common import table
from tests.llm import helpers


def shingles(text):
    words = helpers.words(helpers.lower_ascii(text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def by_rule(rows):
    """Every pair compared."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
            root[find(j)] = find(i)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    least = {r: min((v for v in own if v is not None), default=None) for r, own in ids.items()}
    return [(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)]


def check(frame):
    given = [(row["doc_id"], row["text"]) for row in frame.collect()]
    got = Counter(map(tuple, jaccard.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == Counter(by_rule(given))


def test_edge_rows(spark):
    check(helpers.documents(spark))


def test_sample(spark):
    check(table(spark, "/root/testdata/sf0.001", "documents"))


def test_chains_and_groups_larger_than_a_mask(spark, monkeypatch):
    # Each text is near the next and far from the last; no text is near all.
    words = [f"c{i}" for i in range(400)]
    chain = [" ".join(words[k : k + 100]) for k in range(0, 200, 9)]
    star = [helpers.near(helpers.BASE, 2) + f" tail{i} more{i}" for i in range(90)]
    border = []
    for shared in range(80, 90):
        border += [" ".join(f"b{shared}x{i}" for i in range(104)), " ".join(f"b{shared}x{i if i < shared + 4 else -i}" for i in range(104))]
    rows = [(1000 - i, text) for i, text in enumerate(chain + star + border)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check(frame)
    # Without groups of near copies all links are found between groups.
    monkeypatch.setattr(jaccard, "_pivots", lambda *args: spark.createDataFrame([], "node long, pivot long"))
    monkeypatch.setattr(jaccard, "MASK_BITS", 3)
    check(frame)


@pytest.mark.parametrize("percent", [50, 90])
def test_other_thresholds(spark, percent):
    frame = spark.createDataFrame([(1, helpers.BASE), (2, helpers.near(helpers.BASE, 3)), (3, helpers.near(helpers.BASE, 9))], "doc_id long, text string")
    sets = [shingles(row["text"]) for row in frame.collect()]
    got = {row["doc_id"]: row["component_id"] for row in jaccard.jaccard_components(frame, percent=percent).collect()}
    for i in (1, 2):
        near = 100 * len(sets[0] & sets[i]) >= percent * len(sets[0] | sets[i])
        assert (got[i + 1] == 1) == near or got[2] == got[3]


def test_no_rows(spark):
    assert jaccard.jaccard_components(helpers.empty(spark)).count() == 0
    assert jaccard.keep_one(helpers.empty(spark)).count() == 0


def test_connected(spark):
    edges = [(i + 1, i) for i in range(40, 70)] + [(5, 9), (9, 7), (9, 5), (3, 3)] + [(100 + i, 1) for i in range(30)]
    got = {row["node"]: row["root"] for row in jaccard.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 40 for i in range(41, 71)) and got[9] == got[7] == 5
    assert all(got[100 + i] == 1 for i in range(30)) and 3 not in got


def test_one_of_each_group_stays(spark):
    docs = helpers.documents(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    components = {c for (_, n, c), (_, text) in zip(by_rule(rows), rows) if n}
    wordless = sum(1 for _, text in rows if not helpers.words(text))
    out = [(row["doc_id"], row["text"]) for row in kept.collect()]
    assert sum(1 for _, text in out if not helpers.words(text)) == wordless
    assert Counter(doc_id for doc_id, text in out if helpers.words(text)) == Counter(components)
