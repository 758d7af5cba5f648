"""Quality rules: an isolation forest over rule statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import UPPER, map_batches

# The characters that count as symbols, and the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words

SPACES = " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OTHERS = ("n_lines", "n_upper", "n_marks")
STATISTICS = ", ".join(f"{name} long" for name in COUNTS + OTHERS)
MARKS = b"!\"'()+,-./:;=?@[\\]^_`{}~"

# Bounds of the fit, which needs no more rows however many there are.
LABELLED_ROWS = 20_000
TREES, SAMPLE = 200, 256
FALSE_REJECTS = 0.002
SEED = 7


def statistics(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` and ``OTHERS`` of a whole text; null and empty texts have none of anything."""
    if not text:
        return (0,) * (len(COUNTS) + len(OTHERS))
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, UPPER.encode())),
        len(raw) - len(raw.translate(None, MARKS)),
    )


def repeated_words(words: list) -> int:
    """Words that stand in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, until = 0, 0
    for place, window in enumerate(windows):
        if found[window] > 1:
            covered += place + 3 - max(place, until)
            until = place + 3
    return covered


def base_failed(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def features(counts: np.ndarray) -> np.ndarray:
    """Rates that do not grow with the text, a row per document.

    Repetition is squared: the base rules reject the worst of it, and some
    repeated lines are common in good texts.
    """
    n_words, word_chars, n_symbols, n_dup, n_repeat, n_lines, n_upper, n_marks = counts.astype(float).T
    words, chars, lines = np.maximum(n_words, 1), np.maximum(word_chars, 1), np.maximum(n_lines, 1)
    return np.column_stack(
        [
            word_chars / words,
            np.log1p(100 * n_symbols / chars),
            np.maximum(n_dup / lines, n_repeat / words) ** 2,
            np.log1p(100 * n_upper / chars),
            np.log1p(100 * n_marks / chars),
        ]
    )


def _mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n values."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Isolation trees as arrays: per tree and node a feature, a cut, the left child, a depth."""

    feature: np.ndarray  # -1: leaf
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray  # of a leaf, its rows' own expected depth added
    levels: int
    normal: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly from 0 to 1: short mean paths score high."""
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for tree in range(len(self.feature)):
            feature, cut, left = self.feature[tree], self.cut[tree], self.left[tree]
            node = np.zeros(len(rows), dtype=np.int32)
            for _ in range(self.levels):
                inner = feature[node] >= 0
                right = rows[each, np.maximum(feature[node], 0)] >= cut[node]
                node = np.where(inner, left[node] + right, node)
            total += self.depth[tree][node]
        return 2.0 ** (-total / (len(self.feature) * self.normal))


def grow_forest(
    rows: np.ndarray, box: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> Forest:
    """Trees of random splits, each over a random sample of the rows.

    A node splits its part of the ``box`` (least and largest value per feature)
    at random, not the range its rows fill. So a stretch without rows is cut
    off early, and what falls there has a short path.
    """
    random = np.random.default_rng(seed)
    sample = min(sample, len(rows))
    levels = max(1, math.ceil(math.log2(max(sample, 2))))
    size = 2 ** (levels + 1) + 1
    feature = np.full((trees, size), -1, dtype=np.int32)
    cut, depth = np.zeros((trees, size)), np.zeros((trees, size))
    left = np.zeros((trees, size), dtype=np.int32)
    for tree in range(trees):
        waiting = [(0, 0, rows[random.choice(len(rows), sample, replace=False)], box)]
        used = 1
        while waiting:
            node, level, own, part = waiting.pop()
            wide = np.flatnonzero(part[1] > part[0])
            if level == levels or len(own) <= 1 or not len(wide):
                depth[tree, node] = level + _mean_path(len(own))
                continue
            column = random.choice(wide)
            at = random.uniform(*part[:, column])
            feature[tree, node], cut[tree, node], left[tree, node] = column, at, used
            right = own[:, column] >= at
            low, high = part.copy(), part.copy()
            low[1, column] = high[0, column] = at
            waiting += [(used, level + 1, own[~right], low), (used + 1, level + 1, own[right], high)]
            used += 2
    return Forest(feature, cut, left, depth, levels, max(_mean_path(sample), 1.0))


@dataclass
class QualityModel:
    """A forest and the score from which a document is an anomaly; neither if nothing was labelled."""

    forest: Forest | None
    threshold: float

    def judge(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(base_failed, score, kept) of rows of statistics."""
        failed = base_failed(counts[:, 0], counts[:, 4])
        if self.forest is None:
            return failed, np.zeros(len(counts)), ~failed
        score = self.forest.score(features(counts))
        return failed, score, ~failed & (score < self.threshold)


def calibrate(scores: np.ndarray, good: np.ndarray, false_rejects: float = FALSE_REJECTS) -> float:
    """The score that parts the labelled rows best, among those that reject few good ones.

    Bad rows found less good rows lost, as shares of their kinds; of equal
    thresholds the highest. Half way to the next lower score, so that rows like
    the good ones stay.
    """
    order = np.unique(scores)
    if not good.any() or good.all():
        return math.inf
    best = (0.0, math.inf)
    for low, at in zip(order, order[1:]):
        threshold = (low + at) / 2
        rejected = scores >= threshold
        lost = rejected[good].mean()
        gain = rejected[~good].mean() - lost
        if lost <= false_rejects and gain >= best[0] and gain > 0:
            best = (gain, threshold)
    return best[1]


def with_statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of every whole text."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def start():
        def measure(batch: pa.RecordBatch) -> dict:
            found = [statistics(text) for text in batch["text"].to_pylist()]
            columns = zip(*found) if found else [[]] * len(COUNTS + OTHERS)
            return {"doc_id": batch["doc_id"], **dict(zip(COUNTS + OTHERS, map(list, columns)))}

        return measure

    return map_batches(rows, start, f"doc_id long, {STATISTICS}")


def labelled_ids(labels: DataFrame, label_col: str = "quality", rows: int = LABELLED_ROWS) -> DataFrame:
    """doc_id and label of at most ``rows`` labelled ids, the first by a hash."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def fit_quality(
    measured: DataFrame, labels: DataFrame, *, label_col: str = "quality", rows: int = LABELLED_ROWS
) -> QualityModel:
    """Grow the forest and set its threshold on labelled documents the base rules pass.

    At most ``rows`` labelled ids are taken; null ids and values fall away, and of several labels or documents of an id the smallest
    counts. Trees isolate good rows; the threshold is where bad ones part from
    them. With fewer than 32 good rows there is no forest and the base rules
    decide.
    """
    chosen = labelled_ids(labels, label_col, rows)
    # At most ``rows`` ids: they go to the statistics, which are not shuffled.
    labelled = (
        measured.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(F.struct(*COUNTS, *OTHERS)).alias("counts"))
        .orderBy("doc_id")
        .collect()
    )
    counts = np.array([tuple(row["counts"]) for row in labelled], dtype=np.int64)
    good = np.array([row["label"] > 0 for row in labelled], dtype=bool)
    if good.sum() < 32:
        return QualityModel(None, math.inf)
    rates = features(counts)
    forest = grow_forest(rates[good], np.stack([rates.min(axis=0), rates.max(axis=0)]))
    return QualityModel(forest, calibrate(forest.score(rates), good))


def judge_quality(measured: DataFrame, model: QualityModel) -> DataFrame:
    """Statistics with base_failed, score and kept.

    Null and empty texts have no words and fail the base rules; repeated rows
    are judged alike; no rows give none.
    """
    given = measured.sparkSession.sparkContext.broadcast(model)

    def start():
        def judge(batch: pa.RecordBatch) -> dict:
            own = {name: batch[name] for name in ("doc_id", *COUNTS, *OTHERS)}
            counts = np.column_stack([batch[name].to_numpy() for name in COUNTS + OTHERS])
            failed, score, kept = given.value.judge(counts)
            return own | {
                "base_failed": pa.array(failed),
                "score": pa.array(score),
                "kept": pa.array(kept),
            }

        return judge

    return map_batches(
        measured, start, f"doc_id long, {STATISTICS}, base_failed boolean, score double, kept boolean"
    )


def keep_good(documents: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The documents the rules and the forest keep, all their columns as they are."""
    given = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text) for text in batch[text_col].to_pylist()]
            if found:
                kept = given.value.judge(np.array(found, dtype=np.int64))[2]
                yield batch.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)
