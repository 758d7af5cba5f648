from collections import Counter, defaultdict

import pytest

from quotewright.llm import mix
from quotewright.llm.common import table
from tests.llm import helpers


def targets(sizes):
    """Shared by weight again and again until no source is above its cap."""
    names = sorted((name for name in sizes if name is not None), key=lambda name: name.encode())
    names += [None] if None in sizes else []
    weights = {name: i % 3 + 1 for i, name in enumerate(names)}
    total, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        left = total - sum(out.values())
        share = {name: left * weights[name] / sum(weights[n] for n in open_) for name in open_}
        above = [name for name in open_ if share[name] >= 3 * sizes[name]]
        if not above:
            out |= share
            break
        out |= {name: 3 * sizes[name] for name in above}
        open_ -= set(above)
    return out


@pytest.mark.parametrize("edge", [True, False])
def test_mix(spark, sample, edge):
    docs = helpers.documents(spark) if edge else table(spark, sample, "documents")
    rows = mix.mix_sources(docs).collect()
    given = Counter((row["doc_id"], row["source"], len(helpers.words(row["text"]))) for row in docs.collect())
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == given
    sizes = defaultdict(int)
    for (_, source, size), count in given.items():
        sizes[source] += size * count
    expected, taken = targets(sizes), defaultdict(int)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - expected[row["source"]]) <= 1e-6 * (1 + row["target"])
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source"]] += row["taken"]
    largest = defaultdict(int)
    for row in rows:
        largest[row["source"]] = max(largest[row["source"]], row["size"])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1
        assert all(r["taken"] % r["size"] == 0 for r in rows if r["size"])
    placed = [row["position"] for row in rows if row["position"] is not None]
    assert placed == sorted(placed) and 0 <= placed[0] and placed[-1] < 1
    assert [tuple(row) for row in mix.mix_sources(docs.repartition(3)).collect()] == [tuple(row) for row in rows]


def test_placements_take_what_is_taken(spark):
    mixed = mix.mix_sources(helpers.documents(spark))
    words = Counter()
    for row in mix.placements(mixed).collect():
        assert 0 < row["words"] <= row["size"] and 0 <= row["position"] < 1
        words[(row["doc_id"], row["source"], row["size"], row["copy"])] += row["words"]
    taken = {(r["doc_id"], r["source"], r["size"], r["copy"]): r["taken"] for r in mixed.collect() if r["taken"]}
    assert words == taken


def test_time_inverts_the_integral(spark):
    from pyspark.sql import functions as F

    for start, end in ((1.0, 1.0), (1.0, 3.0), (2.0, 0.5)):
        frame = spark.range(11).select((F.col("id") / 10).alias("share"))
        for row in frame.select("share", mix.due_time(F.col("share"), F.lit(start), F.lit(end)).alias("t")).collect():
            due = (start * row["t"] + (end - start) * row["t"] ** 2 / 2) / ((start + end) / 2)
            assert abs(due - row["share"]) < 1e-12


def test_mixed_documents(spark):
    docs = helpers.documents(spark)
    out = mix.mixed_documents(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for row in out.collect():
        words[row["source"]] += len(helpers.words(row["text"]))
    for row in mix.mix_sources(docs).groupBy("source").sum("taken").collect():
        assert words[row["source"]] == row["sum(taken)"]
    # Whole rows as they came, each as often as the mix takes it, not in a row of passes.
    given = Counter(tuple(row) for row in docs.collect())
    found = Counter(tuple(row) for row in out.collect())
    assert set(found) <= set(given) and all(count <= 3 * given[row] for row, count in found.items())


def test_rows_of_one_key_keep_their_own_texts(spark):
    """Rows equal in id, source and size, some in all columns."""
    rows = [(1, f"a{i // 2} b c", "s") for i in range(6)] + [(1, "x y z", "s")] * 3 + [(i, "p q", "t") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = Counter(tuple(row) for row in mix.mixed_documents(docs).collect())
    given = Counter(rows)
    mixed = mix.mix_sources(docs).collect()
    assert sum(out.values()) == sum(row["taken"] // row["size"] for row in mixed)
    assert set(out) <= set(given) and all(count <= 3 * given[row] for row, count in out.items())


def test_no_rows(spark):
    nothing = helpers.empty(spark)
    assert mix.mix_sources(nothing).count() == 0 and mix.mixed_documents(nothing).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"], r["position"]) for r in mix.mix_sources(wordless).collect()] == [(0.0, 0, None)] * 2


def test_no_python_in_the_plan(spark, sample):
    plan = mix.mixed_documents(table(spark, sample, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
