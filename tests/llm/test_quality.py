from collections import Counter

import numpy as np

from quotewright.llm import quality
from tests.llm import helpers


def by_rule(text):
    words = helpers.words(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    found = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if found[window] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if helpers.words(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_by_rule(spark):
    docs = helpers.documents(spark)
    measured = quality.with_statistics(docs)
    got = Counter(map(tuple, measured.select("doc_id", *quality.COUNTS).collect()))
    assert got == Counter((row["doc_id"], *by_rule(row["text"])) for row in docs.collect())


def test_repeats_and_symbols():
    for text in ("a b c a b c", "a a a a a", "a b c d a b c x c d a", "# x\n# x\n\n \n# x |<>", "a b", "\n\n"):
        assert quality.statistics(text)[:5] == by_rule(text)


def test_without_labels_the_base_rules_decide(spark):
    measured = quality.with_statistics(helpers.documents(spark))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judge_quality(measured, quality.fit_quality(measured, labels)).collect()
    assert rows and all(row["kept"] == (not row["base_failed"]) for row in rows)
    assert all(row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]) for row in rows)


def test_no_rows(spark):
    measured = quality.with_statistics(helpers.empty(spark))
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    assert quality.judge_quality(measured, quality.fit_quality(measured, labels)).count() == 0


def test_forest_finds_what_is_outside():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (2000, 5))
    bad = rng.normal(0, 1, (60, 5)) + np.array([0, 0, 9, 0, 0])
    rows = np.concatenate([good, bad])
    forest = quality.grow_forest(good, np.stack([rows.min(axis=0), rows.max(axis=0)]))
    scores, labels = forest.score(rows), np.arange(len(rows)) < len(good)
    threshold = quality.calibrate(scores, labels)
    assert (scores[labels] >= threshold).mean() <= quality.FALSE_REJECTS
    assert (scores[~labels] >= threshold).mean() > 0.7


def test_score_is_the_mean_path():
    rng = np.random.default_rng(2)
    rows = rng.normal(0, 1, (300, 3))
    forest = quality.grow_forest(rows, np.stack([rows.min(axis=0), rows.max(axis=0)]), trees=5)
    for row, score in zip(rows[:20], forest.score(rows[:20])):
        total = 0.0
        for tree in range(5):
            node = 0
            while forest.feature[tree, node] >= 0:
                node = forest.left[tree, node] + (row[forest.feature[tree, node]] >= forest.cut[tree, node])
            total += forest.depth[tree, node]
        assert abs(score - 2 ** (-total / (5 * forest.normal))) < 1e-12


def test_calibration_spares_good_rows():
    scores = np.array([0.1, 0.2, 0.3, 0.4, 0.5])
    assert abs(quality.calibrate(scores, np.array([1, 1, 1, 0, 0], bool), 0.0) - 0.35) < 1e-12
    assert quality.calibrate(scores, np.array([0, 0, 1, 1, 1], bool), 0.0) == np.inf
    assert quality.calibrate(scores, np.ones(5, bool)) == np.inf


def test_kept_documents_are_unchanged(spark):
    docs = helpers.documents(spark)
    model = quality.QualityModel(None, np.inf)
    kept = Counter(map(tuple, quality.keep_good(docs, model).collect()))
    n_words, repeats = quality.COUNTS.index("n_words"), quality.COUNTS.index("n_repeat_words")
    counted = [(row, quality.statistics(row["text"])) for row in docs.collect()]
    assert kept == Counter(tuple(row) for row, s in counted if not quality.base_failed(s[n_words], s[repeats]))


def test_junk_is_rejected_on_the_sample(spark):
    from quotewright.llm.common import table

    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    labelled = table(spark, folder, "documents").join(labels, "doc_id")
    measured = quality.with_statistics(labelled)
    judged = quality.judge_quality(measured, quality.fit_quality(measured, labels)).join(labels, "doc_id")
    rows = judged.filter("not base_failed").select("kept", "quality").collect()
    good = [row["kept"] for row in rows if row["quality"] == 1]
    bad = [row["kept"] for row in rows if row["quality"] == 0]
    assert np.mean(good) >= 0.995 and np.mean(bad) <= 0.25
