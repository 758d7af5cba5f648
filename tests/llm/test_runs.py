import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quotewright.llm import queries, runs
from tests.llm import helpers

NAMES = [part.split()[0] for part in runs.RUNS.split(", ")]


def brute_runs(words, least_words=6, least_periods=4):
    """Maximal stretches for every period; a stretch counts for its smallest one."""
    n, found = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - i
            if end > i and length >= max(least_words, least_periods * q):
                found.setdefault((i, length), q)
            i = max(end, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = helpers.words(text)
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def searched(words):
    numbers = {}
    tokens = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    return list(zip(*(part.tolist() for part in runs.find_runs(tokens, len(words)))))


def test_all_short_words_over_two_letters():
    for n in range(1, 15):
        for code in range(1 << (n - 1)):
            words = [code >> i & 1 for i in range(n)]
            assert searched(words) == brute_runs(words), words


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_repeats(letters):
    rng = random.Random(letters)
    for _ in range(150):
        words = []
        while len(words) < rng.randint(10, 400):
            part = rng.choices(range(letters), k=rng.randint(1, 30))
            if rng.random() < 0.4:
                part = part[: rng.randint(1, 6)] * rng.randint(1, 9) + part
            words += (part * rng.choice((1, 1, 2, 4, 5, 9)))[: rng.randint(1, 400)]
        assert searched(words) == brute_runs(words), words


def test_runs_of_runs():
    block = [1] * 9 + [2]
    outer = (block * 5 + [3]) * 6
    assert searched(outer) == brute_runs(outer)
    fibonacci, last = [0, 1], [0]
    while len(fibonacci) < 600:
        fibonacci, last = fibonacci + last, fibonacci
    assert searched(fibonacci) == brute_runs(fibonacci)


def test_progressions_are_met():
    """Blocks with three or more occurrences ahead inside a run of a longer period."""
    words = ([7] * 5 + [8, 9] + [7] * 11 + [8]) * 5
    assert searched(words) == brute_runs(words)


def test_wavelet_tree():
    rng = np.random.default_rng(2)
    values = rng.permutation(777)
    tree = runs.WaveletTree(values)
    for _ in range(200):
        low, high = sorted(rng.integers(0, 778, 2))
        bound = int(rng.integers(0, 1100))
        one = lambda x: np.array([x])
        part = sorted(values[low:high])
        assert tree.below(one(low), one(high), one(bound))[0] == sum(v < bound for v in part)
        if part:
            place = int(rng.integers(0, len(part)))
            assert tree.nth(one(low), one(high), one(place))[0] == part[place]


def test_every_edge_case(spark, monkeypatch):
    monkeypatch.setattr(runs, "STEP_WORDS", 500)
    frame = helpers.documents(spark)
    more = [(100 + i, " ".join((["a", "b", "c"][: i % 3 + 1] * 40)[: 30 + i])) for i in range(60)]
    more += [(500, "the same line again\n" * 7), (501, " ".join(["x"] * 6)), (502, "x x x x x"), (503, "x " * 3000)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    frame = frame.unionByName(extra, allowMissingColumns=True)
    rows = [(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()]
    short = frame.filter("text is null or length(text) < 20000")
    expected = Counter(brute(i, text) for i, text in rows if text is None or len(text) < 20_000)
    result = runs.periodic_runs(short, change=runs.planted)
    assert Counter(tuple(row[name] for name in NAMES) for row in result.collect()) == expected
    assert runs.periodic_runs(frame).count() == len(rows)


def test_texts_and_runs(spark):
    frame = spark.createDataFrame([(1, "a a a a a a b é\né é é é é é x")], "doc_id long, text string")
    row = runs.periodic_runs(frame, with_text=True).first()
    assert row["collapsed"] == "a b é x" and [tuple(run) for run in row["runs"]] == [(0, 6, 1), (7, 7, 1)]


def test_no_rows(spark):
    assert runs.periodic_runs(helpers.empty(spark)).count() == 0


def test_query_against_brute_force(spark, sample):
    frame = queries.table(spark, sample, "documents")
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    expected = {i: text for i, text in rows if len((text or "").split()) < 3000}
    found = {row["doc_id"]: tuple(row[n] for n in NAMES) for row in queries.op13_runs(spark, sample).collect()}
    assert len(found) == len(rows)
    assert {i: found[i] for i in expected} == {i: brute(i, text) for i, text in expected.items()}
