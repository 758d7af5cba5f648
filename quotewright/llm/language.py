"""Language identification by a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import map_batches

UNDETERMINED = "und"

# The network: bytes of a window, size of their vectors, widths and number of filters.
WINDOW, BYTE_SIZE, WIDTHS, FILTERS = 192, 8, (2, 3, 4), 8
# Bounds of the fit: documents per language, windows per document; beyond LANGUAGES labels
# each has its share of the documents of that many, but LEAST_DOCUMENTS at least.
DOCUMENTS, WINDOWS, LANGUAGES, LEAST_DOCUMENTS = 400, 4, 256, 8
EPOCHS, BATCH, RATE, SEED = 6, 64, 3e-3, 11
WINDOWS_AT_ONCE = 128
BROADCAST_LABELS = 50_000
# Fixed value: documents whose remainder is 0 are held out.
FOLDS = 5


def windows_of(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """All of a text's bytes in rows of ``size``, zeros at the end; the last row may be short.

    A rest under a quarter of a window that follows a whole one starts earlier,
    so that it has context.
    """
    data = np.frombuffer(raw, dtype=np.uint8)
    count = max(1, -(-len(data) // size))
    if count > 1 and len(data) % size:
        head = data[: (count - 1) * size].reshape(-1, size)
        return np.concatenate([head, data[-size:][None]])
    out = np.zeros((count, size), dtype=np.uint8)
    out.reshape(-1)[: len(data)] = data
    return out


@dataclass
class ByteNet:
    """Byte vectors, filters of several widths, the maximum over places, softmax."""

    languages: list[str]
    vectors: np.ndarray  # 256 x BYTE_SIZE
    filters: list[np.ndarray]  # width x BYTE_SIZE x FILTERS
    bias: np.ndarray  # of the filters
    dense: np.ndarray  # filters x languages
    dense_bias: np.ndarray

    def maxima(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and its place.

        A filter's response is the sum, over its places, of what the byte there
        adds; that is looked up by byte.
        """
        values, places = [], []
        for own in self.filters:
            width = len(own)
            length = windows.shape[1] - width + 1
            total = None
            for offset in range(width):
                adds = (self.vectors @ own[offset]).astype(np.float32)
                part = adds[windows[:, offset : offset + length]]
                total = part if total is None else np.add(total, part, out=total)
            place = total.argmax(axis=1)
            places.append(place)
            values.append(np.take_along_axis(total, place[:, None], axis=1)[:, 0])
        return np.concatenate(values, axis=1) + self.bias, np.concatenate(places, axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for start in range(0, len(windows), WINDOWS_AT_ONCE):
            pooled, _ = self.maxima(windows[start : start + WINDOWS_AT_ONCE])
            out.append(softmax(np.maximum(pooled, 0) @ self.dense + self.dense_bias))
        return np.concatenate(out)

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts: the mean of the windows' log probabilities."""
        rows = [windows_of(text) for text in texts]
        starts = np.cumsum([0, *map(len, rows)])[:-1]
        logs = np.log(np.maximum(self.probabilities(np.concatenate(rows)), 1e-9))
        means = np.add.reduceat(logs, starts, axis=0) / np.array([len(row) for row in rows])[:, None]
        shares = softmax(means)
        best = shares.argmax(axis=1)
        return [self.languages[i] for i in best], shares[np.arange(len(best)), best].tolist()


def softmax(values: np.ndarray) -> np.ndarray:
    out = np.exp(values - values.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = SEED) -> ByteNet:
    """Fit the network with Adam on labelled windows; every language weighs the same."""
    random = np.random.default_rng(seed)
    count = len(WIDTHS) * FILTERS
    net = ByteNet(
        languages,
        random.normal(0, 0.5, (256, BYTE_SIZE)),
        [random.normal(0, 1 / np.sqrt(w * BYTE_SIZE), (w, BYTE_SIZE, FILTERS)) for w in WIDTHS],
        np.zeros(count),
        random.normal(0, 1 / np.sqrt(count), (count, len(languages))),
        np.zeros(len(languages)),
    )
    weights = [net.vectors, *net.filters, net.bias, net.dense, net.dense_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    share = np.bincount(labels, minlength=len(languages)) * len(languages) / max(len(labels), 1)
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(windows))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            step += 1
            gradients = _gradients(net, windows[chosen], labels[chosen], 1 / np.maximum(share, 1e-9))
            for w, g, m, v in zip(weights, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: ByteNet, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the weighted cross entropy; only the places of the maxima take part."""
    pooled, places = net.maxima(windows)
    active = np.maximum(pooled, 0)
    error = softmax(active @ net.dense + net.dense_bias)
    error[np.arange(len(labels)), labels] -= 1
    error *= weight[labels][:, None] / len(labels)
    back = (error @ net.dense.T) * (pooled > 0)
    vectors = np.zeros_like(net.vectors)
    filters = []
    rows = np.arange(len(windows))[:, None]
    for number, own in enumerate(net.filters):
        part = slice(number * FILTERS, (number + 1) * FILTERS)
        change = np.zeros_like(own)
        for offset in range(len(own)):
            held = windows[rows, places[:, part] + offset]  # window x filter
            change[offset] = np.einsum("nfd,nf->df", net.vectors[held], back[:, part])
            np.add.at(vectors, held, back[:, part][..., None] * own[offset].T[None])
        filters.append(change)
    return [vectors, *filters, back.sum(axis=0), active.T @ error, error.sum(axis=0)]


def held_out(id_col: str = "doc_id") -> Column:
    """Documents no model may learn from; a null id is one of them."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(True))


def fit_language(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    documents_per_language: int = DOCUMENTS,
) -> ByteNet | None:
    """Train on a bounded sample of labelled documents that are not held out.

    Every label is learned. The bound is ``documents_per_language`` for each,
    ``WINDOWS`` windows of each document; more labels than ``LANGUAGES`` share
    the documents of that many, ``LEAST_DOCUMENTS`` for each at least, so the
    sample grows with the labels but not with the documents. A few times the
    bound is dealt by a hash of the id, at the share a language needs, and cut
    to the bound in hash order, so a frequent language or a repeated row does
    not crowd one task. None if no row is labelled.
    """
    labelled = documents.filter(~held_out(id_col)).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    letters = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = labelled.filter(F.col("lang").isNotNull()).groupBy("lang").count()
    labels = counts.count()
    bound = documents_per_language
    if labels > LANGUAGES:
        bound = min(bound, max(LEAST_DOCUMENTS, bound * LANGUAGES // labels))
    counts = counts.withColumn("share", 4.0 * bound / F.col("count"))
    if labels <= BROADCAST_LABELS:
        counts = F.broadcast(counts)
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id", "text"), "id", "text")
    chosen = (
        letters.join(counts, "lang")
        .filter(part < F.col("share"))
        .select("lang", "id", "text")
        .distinct()
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= bound)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids, parts = [], [], []
            for lang, id_, text in zip(*(batch[name].to_pylist() for name in ("lang", "id", "text"))):
                rows = windows_of(text.lower().encode("utf-8", "surrogatepass"))
                for row in rows[np.linspace(0, len(rows) - 1, min(WINDOWS, len(rows))).astype(int)]:
                    langs.append(lang)
                    ids.append(id_)
                    parts.append(row.tobytes())
            yield pa.RecordBatch.from_pydict(
                {"lang": langs, "id": ids, "part": pa.array(parts, pa.binary())},
                schema=pa.schema([("lang", pa.string()), ("id", pa.string()), ("part", pa.binary())]),
            )

    rows = chosen.select("lang", "id", "text").mapInArrow(cut, "lang string, id string, part binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda row: (row["lang"], row["id"], bytes(row["part"])))
    languages = sorted({row["lang"] for row in rows})
    windows = np.frombuffer(b"".join(bytes(row["part"]) for row in rows), dtype=np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([languages.index(row["lang"]) for row in rows]), languages)


def predict_language(
    documents: DataFrame, net: ByteNet | None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every document.

    All bytes of the lower-cased text go through the network in windows. Null
    texts and texts without a letter are ``und`` with score 0, as all are if
    nothing was labelled. Repeated rows get the same answer; no rows give none;
    other columns, the label among them, are not looked at.
    """
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(id_col).alias("held_out"),
        F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("text"),
    )
    given = documents.sparkSession.sparkContext.broadcast(net)

    def start():
        def predict(batch: pa.RecordBatch) -> dict:
            texts = batch["text"].to_pylist()
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            known = [i for i, text in enumerate(texts) if text is not None and given.value]
            for at in range(0, len(known), 64):
                some = known[at : at + 64]
                found = given.value.predict([texts[i].lower().encode("utf-8", "surrogatepass") for i in some])
                for i, lang, score in zip(some, *found):
                    langs[i], scores[i] = lang, score
            return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": langs, "score": scores}

        return predict

    return map_batches(rows, start, "doc_id long, held_out boolean, lang_pred string, score double")
