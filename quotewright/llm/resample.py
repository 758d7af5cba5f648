"""Importance resampling toward a target distribution, with n-grams hashed by prefix CRCs.

A text is normalised to words parted by one space and scanned once for the CRC-32
of every prefix that ends at a word. The CRC of any run of words is that of the
prefix it ends, with the prefix before it shifted over the run's length and
cancelled: both in GF(2), where a shift is a product with a power of x.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import map_batches, settle

# Features, buckets, the seed of the draw, its least words and percent.
ORDER, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
POLYNOMIAL = 0xEDB88320  # Fixed value: CRC-32, lowest bit first
# Words of texts that are hashed together.
STEP_WORDS = 1 << 18
CELL_ROWS = 1 << 20

# A-Z lowered; ASCII other than letters and digits parts words.
SEPARATED = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code > 127 else 32
    for code in range(256)
)


def normalised(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(SEPARATED).split()


class PrefixCrc:
    """CRC-32 of runs of words from the CRCs of prefixes."""

    SHORT_BITS, LONG_BITS = 8, 40

    def __init__(self) -> None:
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = (step >> np.uint32(1)) ^ np.where(step & 1, np.uint32(POLYNOMIAL), np.uint32(0))
        self.step = step
        # What a shift by 0, 1, … bytes makes of each value of each of four bytes.
        shifted = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
        tables = []
        for _ in range((1 << self.SHORT_BITS) + 1):
            tables.append(shifted)
            shifted = (shifted >> np.uint32(8)) ^ step[shifted & 255]
        self.short = np.concatenate([t.ravel() for t in tables[:-1]])
        self.doubled = [tables[-1].ravel()]
        while len(self.doubled) < self.LONG_BITS - self.SHORT_BITS:
            last = self.doubled[-1]
            self.doubled.append(self._through(last, 0, last))

    @staticmethod
    def _through(table: np.ndarray, base, crcs: np.ndarray) -> np.ndarray:
        out = table[base + (crcs & 255)]
        for byte in (1, 2, 3):
            out = out ^ table[base + 256 * byte + ((crcs >> np.uint32(8 * byte)) & 255)]
        return out

    def shift(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The CRCs as if so many zero bytes followed, before any byte of the run counts."""
        crcs = self._through(self.short, (lengths & ((1 << self.SHORT_BITS) - 1)) * 1024, crcs)
        rest = lengths >> self.SHORT_BITS
        for table in self.doubled:
            if not rest.any():
                break
            odd = np.flatnonzero(rest & 1)
            crcs[odd] = self._through(table, 0, crcs[odd])
            rest = rest >> 1
        return crcs

    def prefixes(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """CRCs of the prefixes before and after each word, a space before the first one too."""
        crc32, after, before = zlib.crc32, [], []
        for words in texts:
            value = 0
            for word in words:
                before.append(value)
                value = crc32(b" " + word, value)
                after.append(value)
        ends = np.array(after, dtype=np.uint32)
        starts = ~np.array(before, dtype=np.uint32)
        starts = ~((starts >> np.uint32(8)) ^ self.step[(starts & 255) ^ 32])
        return starts, ends

    def runs(self, texts: list[list[bytes]], order: int) -> tuple[np.ndarray, np.ndarray]:
        """CRCs of all runs of 1 to ``order`` words of each text, and how many each text has."""
        starts, ends = self.prefixes(texts)
        counts = np.array([len(words) for words in texts], dtype=np.int64)
        sizes = np.fromiter((len(word) for words in texts for word in words), dtype=np.int64, count=int(counts.sum()))
        stops = np.cumsum(sizes + 1)
        last = np.repeat(np.cumsum(counts), counts)
        owner = np.repeat(np.arange(len(texts)), counts)
        places = np.arange(len(sizes))
        found, owners = [], []
        for size in range(1, order + 1):
            first = places[places + size <= last]
            end = first + size - 1
            lengths = stops[end] - stops[first] + sizes[first]
            found.append(ends[end] ^ self.shift(starts[first], lengths))
            owners.append(owner[first])
        crcs, owner = np.concatenate(found), np.concatenate(owners)
        if order > 1:
            crcs = crcs[np.argsort(owner, kind="stable")]
        return crcs, np.bincount(owner, minlength=len(texts))


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


def features(rows: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """n_words, n_features and the packed buckets of the features of (doc_id, text)."""

    def start() -> Callable[[pa.RecordBatch], dict]:
        crc = PrefixCrc()

        def take(batch: pa.RecordBatch) -> dict:
            texts = batch["text"].cast(pa.binary())
            words: list[int] = []
            counts: list[int] = []
            packed: list[bytes] = []
            held: list[list[bytes]] = []
            size = 0

            def flush() -> None:
                crcs, own = crc.runs(held, order)
                codes = (crcs % np.uint32(buckets)).astype(_kind(buckets))
                words.extend(map(len, held))
                counts.extend(own.tolist())
                packed.extend(part.tobytes() for part in np.split(codes, np.cumsum(own)[:-1]))

            for value in texts:
                held.append(normalised(value.as_py()))
                size += len(held[-1])
                if size >= STEP_WORDS:
                    flush()
                    held, size = [], 0
            if held:
                flush()
            return {"doc_id": batch["doc_id"], "n_words": words, "n_features": counts, "buckets": packed}

        return take

    return map_batches(rows.select("doc_id", "text"), start, FEATURES)


def _counts(measured: DataFrame, buckets: int) -> dict[int, int]:
    """Features of each bucket: summed in each task, a row a bucket at most for the driver."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch["buckets"]:
                total += np.bincount(np.frombuffer(value.as_buffer(), dtype=_kind(buckets)), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], schema=schema)

    found = measured.select("buckets").mapInArrow(count, "bucket long, n long")
    return {row["bucket"]: row["n"] for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """How much likelier each bucket is in the target, in thousandths of a nat, smoothed by one."""
    all_source, all_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [
        math.floor(1000 * math.log(float(target.get(b, 0) + 1) * all_source / (float(source.get(b, 0) + 1) * all_target)))
        for b in range(buckets)
    ]


def _weighed(measured: DataFrame, gain: list[int], buckets: int) -> DataFrame:
    """The sum of the gains of a document's features."""

    def start() -> Callable[[pa.RecordBatch], dict]:
        own = np.array(gain, dtype=np.int64)

        def weigh(batch: pa.RecordBatch) -> dict:
            codes = (np.frombuffer(value.as_buffer(), dtype=_kind(buckets)) for value in batch["buckets"])
            weights = [int(own[code].sum()) for code in codes]
            return {name: batch[name] for name in ("doc_id", "n_words", "n_features")} | {"weight": weights}

        return weigh

    return map_batches(measured, start, "doc_id long, n_words long, n_features long, weight long")


def _noise(seed: int) -> Column:
    """A document's Gumbel noise in thousandths, from the hash of its id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    part = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((part + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_resample(
    documents: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    order: int = ORDER,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row.

    Features are all runs of 1 to ``order`` words, repeats counted; weight is
    the sum of their buckets' gains, score adds noise of the id. Of the rows
    with ``least_words`` or more the given percent with the highest scores is
    drawn, without replacement, and ranked from 1, ties by smaller id. Others
    have a null rank.

    Null texts, texts without words and no rows have no features and a weight
    of 0; an empty target gives even gains. A null id has the noise of an empty
    one and comes last in a tie. Rows equal in id and text have equal scores
    and neighbouring ranks. Other columns are not looked at.

    Texts are read once. Each task sums its buckets before they are shuffled.
    Scores are range-partitioned and counted a range at a time; only ranges
    that reach into the draw are numbered.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_text_col).alias("text"))
    measured = settle(features(rows, order, buckets), "features")
    gain = gains(_counts(measured, buckets), _counts(features(wanted, order, buckets), buckets), buckets)
    scored = settle(_weighed(measured, gain, buckets).withColumn("score", F.col("weight") + _noise(seed)), "scored")

    some = scored.filter(F.col("n_words") >= least_words)
    total = some.count()
    drawn = percent * total // 100
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // CELL_ROWS))
    highest = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranged = settle(some.repartitionByRange(cells, *highest).withColumn("cell", F.spark_partition_id()), "ranged")
    ahead = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("cell").agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("before")
    # A row a range, whose number is set above.
    placed = ranged.join(F.broadcast(sizes.select("cell", before)), "cell")
    inside = Window.partitionBy("cell").orderBy(*highest)
    rank = F.col("before") + F.row_number().over(inside)
    none = F.lit(None).cast("long")
    names = ("doc_id", "n_features", "weight", "score", "rank")
    first = placed.filter(F.col("before") < drawn).withColumn("rank", rank)
    first = first.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    later = placed.filter(F.col("before") >= drawn).withColumn("rank", none)
    short = scored.filter(F.col("n_words") < least_words).withColumn("rank", none)
    return first.select(*names).unionByName(later.select(*names)).unionByName(short.select(*names))


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """The noise of one id, for tests and single scores."""
    part = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((part + 0.5) / 4294967296)))
