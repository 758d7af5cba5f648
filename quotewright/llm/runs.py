"""Periodic runs of words by internal pattern matching.

A run of period q holds, for the power of two B with B ≤ q < 2B, a block of B
words at a multiple of B that occurs again q words on. For each such block the
occurrences that start B to 2B − 1 words later are asked for: the suffix array
has a block's occurrences in one range, and a wavelet tree over it gives the
next one after a place. There being B places for a block of B words, the
occurrences are a progression of the block's own period; two candidate periods
at most come from it. Common extensions turn a candidate into its run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import map_batches

# Least words of a run, and least periods it holds.
LEAST_WORDS, LEAST_PERIODS = 6, 4
# Words of texts that are searched together.
STEP_WORDS = 1 << 18


class Blocks:
    """Which blocks of 1, 2, 4, … words are equal, and the suffix array they end in.

    ``tokens`` are those of several texts, no token in two of them, so equal
    blocks are of one text. ``ranks[k][i]`` is the place at which blocks equal
    to the one of 2**k words at i start in the sorted order. Blocks that are
    settled as the only ones of their kind are sorted no more.
    """

    def __init__(self, tokens: np.ndarray, longest: int):
        n = self.n = len(tokens)
        order = np.argsort(tokens, kind="stable")
        rank = np.empty(n, dtype=np.int32)
        rank[order] = self._firsts(tokens[order])
        self.ranks, self.order = [rank], order
        size = 1
        while 2 * size <= longest:
            counts = np.bincount(rank, minlength=n)
            open_places = np.flatnonzero(counts[rank[order]] > 1)
            if not len(open_places):
                break
            starts = order[open_places]
            after = starts + size
            second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
            keys = rank[starts].astype(np.int64) * (n + 1) + second + 1
            by_key = np.argsort(keys, kind="stable")
            order = order.copy()
            order[open_places] = starts[by_key]
            firsts = self._firsts(keys[by_key])
            rank = rank.copy()
            rank[starts[by_key]] = open_places[firsts]
            self.ranks.append(rank)
            self.order = order
            size *= 2

    @staticmethod
    def _firsts(values: np.ndarray) -> np.ndarray:
        """For each place of sorted values the first place of its value."""
        new = np.ones(len(values), dtype=bool)
        new[1:] = values[1:] != values[:-1]
        return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))

    def _same(self, level: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Are the blocks equal that start there; outside of the texts nothing is."""
        rank, inside = self.ranks[level], (first >= 0) & (second < self.n)
        return inside & (rank[np.maximum(first, 0)] == rank[np.minimum(second, self.n - 1)])

    def extend(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many words from ``first`` on equal those from ``second`` on, first < second."""
        return self._extended(first, second, 1)

    def extend_back(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many words before ``first`` equal those before ``second``."""
        return self._extended(first, second, -1)

    def _extended(self, first: np.ndarray, second: np.ndarray, way: int) -> np.ndarray:
        length = np.zeros(len(first), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            size, top = 1 << level, level == len(self.ranks) - 1
            live = np.arange(len(first))
            while len(live):
                move = length[live] if way > 0 else -length[live] - size
                live = live[self._same(level, first[live] + move, second[live] + move)]
                length[live] += size
                live = live if top else live[:0]
        return length


class WaveletTree:
    """The least value not below a bound, in ranges of a sequence of 0 … n − 1."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.bits = max(1, int(n - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            count = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(zero, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are less than the bound."""
        out = np.zeros(len(low), dtype=np.int64)
        full = bound >= 1 << self.bits
        low, high, total = low.copy(), high.copy(), high - low
        for level, count in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            zero_low, zero_high = count[low], count[high]
            out += np.where(one, zero_high - zero_low, 0)
            low = np.where(one, low - zero_low + count[-1], zero_low)
            high = np.where(one, high - zero_high + count[-1], zero_high)
        return np.where(full, total, out)

    def nth(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value of [low, high) that has ``place`` smaller ones there."""
        value = np.zeros(len(low), dtype=np.int64)
        low, high, place = low.copy(), high.copy(), place.copy()
        for level, count in enumerate(self.zeros):
            zero_low, zero_high = count[low], count[high]
            zeros = zero_high - zero_low
            one = place >= zeros
            value += np.where(one, 1 << (self.bits - 1 - level), 0)
            place = np.where(one, place - zeros, place)
            low = np.where(one, low - zero_low + count[-1], zero_low)
            high = np.where(one, high - zero_high + count[-1], zero_high)
        return value


def _candidates(blocks: Blocks, tree: WaveletTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): blocks of a level with the periods their later occurrences allow."""
    size, rank = 1 << level, blocks.ranks[level]
    starts = np.arange(0, blocks.n, size)
    low = rank[starts].astype(np.int64)
    high = low + np.bincount(rank, minlength=blocks.n)[low]
    several = high - low > 1
    starts, low, high = starts[several], low[several], high[several]
    # Occurrences size to 2 · size - 1 words later, by their places among all of the block.
    least, most = tree.below(low, high, starts + size), tree.below(low, high, starts + 2 * size)
    met = most > least
    starts, low, high, least, most = (x[met] for x in (starts, low, high, least, most))
    first = tree.nth(low, high, least)
    last = tree.nth(low, high, most - 1)
    few = most - least <= 2
    places = [starts[few], starts[few & (last > first)]]
    periods = [(first - starts)[few], (last - starts)[few & (last > first)]]
    # Three or more: a progression of the block's own period. A run of a longer period
    # holds the ends of both stretches of that period, a period of the run apart.
    starts, low, high, least, first = (x[~few] for x in (starts, low, high, least, first))
    step = tree.nth(low, high, least + 1) - first
    period = first + blocks.extend(first, first + step) - starts - blocks.extend(starts, starts + step)
    fits = (period >= size) & (period < 2 * size)
    places.append(starts[fits])
    periods.append(period[fits])
    return np.concatenate(places), np.concatenate(periods)


def find_runs(tokens: np.ndarray, longest: int, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS):
    """start, length and period of all runs, by start and period.

    ``tokens`` are those of several texts, no token in two of them; the longest
    text has ``longest`` words.
    """
    if least_periods < 4:
        raise ValueError("a block is sure to lie in runs of four periods or more")
    none = np.zeros(0, dtype=np.int64)
    if longest < max(least_words, least_periods):
        return none, none, none
    blocks = Blocks(tokens, max(1, longest // least_periods))
    tree = WaveletTree(blocks.order)
    found = []
    for level in range(len(blocks.ranks)):
        place, period = _candidates(blocks, tree, level)
        start = place - blocks.extend_back(place, place + period)
        length = place + period + blocks.extend(place, place + period) - start
        long = length >= np.maximum(least_words, least_periods * period)
        found.append(np.stack([start[long], length[long], period[long]]))
    start, length, period = np.concatenate(found, axis=1)
    # A multiple of a run's period has the same run; its smallest period stays.
    by_run = np.lexsort((period, length, start))
    start, length, period = start[by_run], length[by_run], period[by_run]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    by_start = np.lexsort((period, start))
    return start[by_start], length[by_start], period[by_start]


def planted(tokens: np.ndarray, doc_id: int | None) -> np.ndarray:
    """Every tenth text by the CRC-32 of its id repeats a stretch of itself to its end."""
    n, mixed = len(tokens), zlib.crc32(str(doc_id).encode())
    if doc_id is None or n == 0 or mixed % 10:
        return tokens
    part = mixed // 10
    first = part % n
    period = 1 + (n - first) // (3 + part % 8)
    places = np.arange(n)
    places[first:] = first + (places[first:] - first) % period
    return tokens[places]


RUNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[np.ndarray, int | None], np.ndarray] | None = None,
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
    with_text: bool = False,
) -> DataFrame:
    """The runs of every text and the text without their repeats.

    A run is a stretch of words of smallest period q, of ``least_words`` and
    ``least_periods`` times q at least, which no neighbouring word extends.
    Returns doc_id, n_runs, the longest run (ties: smallest start, then
    period) with its start, length, period and floor(1000 · length / period),
    the SHA-256 of all runs and that of the collapsed text: the words that no
    run holds after its first q words, parted by one space. ``with_text`` adds
    it as ``collapsed``, and ``runs`` as an array. ``change`` may reorder a
    text's words before; it gets them as numbers, with the id.

    Null and empty texts and those of white space have no words and no run.
    Repeated rows give repeated results; a null id is left as it is. No rows
    give none; other columns are not looked at.

    Texts are searched some at a time, whole ones; a text needs some 150 bytes
    a word while it is. Nothing is shuffled.
    """

    def start() -> Callable[[pa.RecordBatch], dict]:
        def take(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {name: [] for name in names}
            held: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                words = (text.as_py() or b"").split()
                numbers: dict[bytes, int] = {}
                own = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
                own = change(own, doc_id) if change else own
                held.append((doc_id, list(numbers), own))
                size += len(words)
                if size >= STEP_WORDS:
                    report(held, out)
                    held, size = [], 0
            report(held, out)
            return out

        return take

    def report(held: list[tuple], out: dict[str, list]) -> None:
        if not held:
            return
        sizes = np.array([len(own) for _, _, own in held])
        firsts = np.cumsum(sizes) - sizes
        bases = np.cumsum([0, *(len(words) for _, words, _ in held[:-1])])
        tokens = np.concatenate([own + base for (_, _, own), base in zip(held, bases)])
        starts, lengths, periods = find_runs(tokens, int(sizes.max()), least_words, least_periods)
        cuts = np.searchsorted(starts, np.append(firsts, len(tokens)))
        for at, (doc_id, words, own) in enumerate(held):
            mine = slice(cuts[at], cuts[at + 1])
            start, length, period = starts[mine] - firsts[at], lengths[mine], periods[mine]
            kept = np.ones(len(own), dtype=bool)
            for first, end in zip(start + period, start + length):
                kept[first:end] = False
            best = np.lexsort((period, start, -length))[0] if len(start) else None
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(start, length, period))
            collapsed = b" ".join([words[i] for i in own[kept]])
            row = (doc_id, len(start))
            row += (None,) * 4 if best is None else (
                int(start[best]), int(length[best]), int(period[best]), 1000 * int(length[best]) // int(period[best]),
            )
            row += (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())
            runs = [{"start": int(s), "length": int(n), "period": int(q)} for s, n, q in zip(start, length, period)]
            for name, value in zip(names, (*row, collapsed.decode(), runs)):
                out[name].append(value)

    schema = RUNS
    if with_text:
        schema += ", collapsed string, runs array<struct<start: long, length: long, period: long>>"
    names = [part.split()[0] for part in schema.replace("array<struct<start: long, length: long, period: long>>", "x").split(", ")]
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, start, schema)
