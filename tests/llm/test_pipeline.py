from collections import defaultdict

import pytest

import corpus_pipeline
from quotewright.llm import pii, quality
from quotewright.llm.common import settle, table
from tests.llm import helpers
from tests.llm.test_jaccard import by_rule as components
from tests.llm.test_mix import targets


@pytest.fixture(scope="module")
def steps(spark, sample):
    """What each stage got and gave."""
    docs, out = table(spark, sample, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, settle(stage(spark, docs, sample), "step")
        out.append((given, docs))
    return out


def rows(frame):
    return {row["doc_id"]: row for row in frame.collect()}


def test_columns(steps, spark, sample):
    columns = table(spark, sample, "documents").dtypes
    assert all(out.dtypes == columns for _, out in steps[:-1])


def test_quality_stage(steps, spark, sample):
    given, out = map(rows, steps[0])
    labels = table(spark, sample, "labels")
    measured = quality.with_statistics(steps[0][0])
    judged = quality.judge_quality(measured, quality.fit_quality(measured, labels)).collect()
    assert set(out) == {row["doc_id"] for row in judged if row["kept"]}
    assert all(out[i] == given[i] for i in out) and len(out) < len(given)


def test_duplicate_stage(steps):
    given, out = map(rows, steps[1])
    found = components([(i, row["text"]) for i, row in given.items()])
    assert set(out) == {component for _, _, component in found}
    assert all(out[i] == given[i] for i in out)


def test_pii_stage(steps):
    given, out = map(rows, steps[2])
    assert set(out) == set(given)
    for i, row in out.items():
        spans = pii.base_spans(row["text"])
        assert not any(spans.values()) and row["n_chars"] == len(row["text"])
        if row["text"] != given[i]["text"]:
            assert any(f"[{kind.upper()}]" in row["text"] for kind in pii.KINDS)


def test_mix_stage(steps):
    given, out = steps[3]
    sizes, taken = defaultdict(int), defaultdict(int)
    for row in given.collect():
        sizes[row["source"]] += len(helpers.words(row["text"]))
    for row in out.collect():
        taken[row["source"]] += len(helpers.words(row["text"]))
    longest = max(len(helpers.words(row["text"])) for row in given.collect())
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= longest / 2 + 1
    assert {row["text"] for row in out.collect()} <= {row["text"] for row in given.collect()}


def test_packing_stage(steps):
    given, out = steps[4]
    bins = defaultdict(int)
    for row in out.collect():
        bins[row["sequence_id"]] += row["length"]
    assert max(bins.values()) <= 2048 and out.filter("piece = 0").count() == given.count()


def test_edge_rows(spark, sample):
    docs = helpers.documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sample), "edge")
    assert docs.count() > 0


def test_no_rows(spark, sample):
    docs = helpers.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sample), "empty")
    assert docs.count() == 0


def test_run(spark, sample, steps):
    assert corpus_pipeline.run(spark, sample).count() == steps[-1][1].count()
