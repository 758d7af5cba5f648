"""Best-fit packing of tokenized documents, improved by swap-based local search."""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from functools import reduce
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import map_batches, settle

CAPACITY = 2048
# Pieces packed together in one task, and how often leftovers are packed anew.
GROUP = 4096
ROUNDS = 8
# Limits of the search, not of the rows: places looked at for a swap, documents
# of a bin taken in pairs, passes over the underfull bins.
LOOKS, PAIRED, PASSES = 48, 12, 4
CACHE_WORDS = 1_000_000
SLICE_CHARS = 1_000_000
# Marks that are units of their own after letters.
MARKS = (".", ",")


class Visible(dict):
    """Characters as the vocabulary writes their bytes, by code point."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        self.level = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = self.level.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class WordIds(dict):
    """Token ids, as bytes, of words with the one space or line end before them.

    A run of letters is one unit of the vocabulary's merges and so is a mark
    after it; those go to the model straight. Other words take the whole way.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model, self.visible = self.tokenizer.model, Visible()

    def unit(self, text: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(text.translate(self.visible))]).tobytes()

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.unit(f" {word}")
        elif word[-1:] in MARKS and word[:-1].isalpha():
            ids = self[word[:-1]] + self.unit(word[-1])
        elif word[:1] == "\n":
            ids = self.unit("\n") + self.unit(word[1:]) if word[1:].isalpha() else self.whole(word)
        else:
            ids = self.whole(f" {word}")
        self[word] = ids
        return ids


class TokenBytes:
    """Token ids of texts as little-endian bytes.

    The vocabulary's splitting rule lets at most one space before a word join
    it and never passes from a word into the white space after it. So a text
    of words parted by single spaces or line ends is the sum of its words, and
    words are tokenized once. Other texts go to the tokenizer whole, and so do
    those with a string that the vocabulary has a token of its own for.
    """

    def __init__(self, tokenizer_path: str):
        self.words = WordIds(tokenizer_path)
        added = self.words.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]

    def _plain(self, text: str) -> bool:
        """Only single spaces and line ends part the words, and none is special."""
        if any(string in text for string in self.special):
            return False
        if not text or text[0] in " \n" or text[-1] in " \n":
            return False
        if any(pair in text for pair in ("  ", " \n", "\n ", "\n\n")):
            return False
        return not ODD_SPACE.search(text)

    def encode(self, text: str) -> bytes:
        """Long texts are looked up in slices that end before a space."""
        if not self._plain(text):
            return self.words.whole(text) if text else b""
        parts, start = [], 0
        while start < len(text):
            end = text.find(" ", start + SLICE_CHARS)
            end = len(text) if end < 0 else end
            words = text[start:end].replace("\n", " \n").split(" ")
            if not start:  # no space stands before the first word
                parts.append(self.words.whole(words[0]))
                words = words[1:]
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            parts.append(b"".join(map(self.words.__getitem__, words)))
            start = end + 1
        return b"".join(parts)


# White space other than a space or line end.
ODD_SPACE = re.compile(r"[^\S \n]")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def token_pieces(
    documents: DataFrame, tokenizer_path: str, *, id_col: str, text_col: str, capacity: int
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; an id 0 ends each document."""
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def start():
        tokens = TokenBytes(tokenizer_path)

        def pieces(batch: pa.RecordBatch) -> dict:
            places, numbers, starts, lengths, sums = [], [], [], [], []
            for place, text in enumerate(batch["text"].to_pylist()):
                ids = tokens.encode(text) + b"\0\0\0\0"
                for number, (begin, length) in enumerate(cut(len(ids) // 4, capacity)):
                    places.append(place)
                    numbers.append(number)
                    starts.append(begin)
                    lengths.append(length)
                    sums.append(zlib.crc32(ids[4 * begin : 4 * (begin + length)]))
            return {
                "doc_id": batch["doc_id"].take(pa.array(places, pa.int64())),
                "piece": numbers,
                "start": starts,
                "length": lengths,
                "ids_crc32": sums,
            }

        return pieces

    return map_batches(rows, start, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins of document lengths under a capacity."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []
        self._best_fit(sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)))

    def _best_fit(self, order: list[int]) -> None:
        """Each document into the fullest bin that takes it, longest first."""
        with_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0  # bit r: a bin with room r
        for item in order:
            need = self.lengths[item]
            fitting = mask >> need
            if fitting:
                room = need + (fitting & -fitting).bit_length() - 1
                bin_ = with_room[room].pop()
                if not with_room[room]:
                    mask ^= 1 << room
                self.items[bin_].append(item)
                self.room[bin_] -= need
            else:
                bin_ = len(self.items)
                self.items.append([item])
                self.room.append(self.capacity - need)
            left = self.room[bin_]
            with_room[left].append(bin_)
            mask |= 1 << left

    def improve(self) -> None:
        """Shift documents from emptier to fuller bins until nothing gains.

        A move or swap that takes ``d`` words from bin A to bin B changes the
        sum of squared fills by 2d(fill B − fill A + d). Only gains are made, so
        the search ends; bins it empties are dropped.
        """
        for _ in range(PASSES):
            under = sorted((b for b in range(len(self.items)) if self.room[b] and self.items[b]), key=lambda b: -self.room[b])
            if len(under) < 2:
                break
            self._index(under)
            if not sum(self._drain(bin_) for bin_ in under):
                break
        kept = [b for b in range(len(self.items)) if self.items[b]]
        self.items = [self.items[b] for b in kept]
        self.room = [self.room[b] for b in kept]

    def _index(self, under: list[int]) -> None:
        """Bins by room, and (largest length that can take its place, bin, item) by document."""
        self.rooms = sorted((self.room[b], b) for b in under)
        self.tops = sorted((self.lengths[i] + self.room[b], b, i) for b in under for i in self.items[b])

    def _set(self, bin_: int, items: list[int]) -> None:
        """Give a bin other documents; the index follows."""
        for i in self.items[bin_]:
            entry = (self.lengths[i] + self.room[bin_], bin_, i)
            place = bisect_left(self.tops, entry)
            if self.tops[place : place + 1] == [entry]:
                del self.tops[place]
        place = bisect_left(self.rooms, (self.room[bin_], bin_))
        if self.rooms[place : place + 1] == [(self.room[bin_], bin_)]:
            del self.rooms[place]
        self.items[bin_] = items
        self.room[bin_] = self.capacity - sum(self.lengths[i] for i in items)
        if self.room[bin_] and items:
            insort(self.rooms, (self.room[bin_], bin_))
            for i in items:
                insort(self.tops, (self.lengths[i] + self.room[bin_], bin_, i))

    def _drain(self, bin_: int) -> int:
        """Improving steps that take from this bin; how many were made."""
        steps = 0
        while self.items[bin_] and self.room[bin_] and (self._move(bin_) or self._exchange(bin_)):
            steps += 1
        return steps

    def _gains(self, bin_: int, other: int, words: int) -> bool:
        return words > 0 and self.room[bin_] - self.room[other] + words > 0

    def _move(self, bin_: int) -> bool:
        for item in sorted(self.items[bin_], key=lambda i: -self.lengths[i]):
            need = self.lengths[item]
            for _, other in self.rooms[bisect_left(self.rooms, (need, -1)) :][:2]:
                if other != bin_ and self._gains(bin_, other, need):
                    self._set(other, [*self.items[other], item])
                    self._set(bin_, [i for i in self.items[bin_] if i != item])
                    return True
        return False

    def _exchange(self, bin_: int) -> bool:
        """One or two of this bin's documents for a shorter one of another bin."""
        own = sorted(self.items[bin_], key=lambda i: -self.lengths[i])
        offers = [(i,) for i in own] + list(combinations(own[:PAIRED], 2))
        for offer in offers:
            words = sum(self.lengths[i] for i in offer)
            place = bisect_left(self.tops, (words, -1, -1))
            for _, other, item in self.tops[place : place + LOOKS]:
                if other != bin_ and self._gains(bin_, other, words - self.lengths[item]):
                    self._set(other, [i for i in self.items[other] if i != item] + [*offer])
                    self._set(bin_, [i for i in self.items[bin_] if i not in offer] + [item])
                    return True
        return False


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of the places of ``lengths``, none above ``capacity``."""
    bins = Bins(lengths, capacity)
    bins.improve()
    return bins.items


PIECE = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECE}, sequence_id long, offset long, open boolean"


def _packed(pieces: DataFrame, group: int, round_: int, capacity: int) -> DataFrame:
    """Pack open pieces in groups dealt by a hash; mark the bins left underfull."""
    count = pieces.count()
    groups = max(1, -(-count // group))
    final = groups == 1

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        number = table["group"][0].as_py()
        lengths = table["length"].to_pylist()
        places, ids, offsets, open_ = [], [], [], []
        for bin_number, items in enumerate(pack(lengths, capacity)):
            fill = 0
            for item in sorted(items):
                places.append(item)
                ids.append((round_ << 56) | (number << 20) | bin_number)
                offsets.append(fill)
                fill += lengths[item]
            open_ += [not final and fill < capacity] * len(items)
        packed = table.drop_columns("group").take(pa.array(places, pa.int64()))
        packed = packed.append_column("sequence_id", pa.array(ids, pa.int64()))
        packed = packed.append_column("offset", pa.array(offsets, pa.int64()))
        return packed.append_column("open", pa.array(open_, pa.bool_()))

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(run, PACKED)


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    group: int = GROUP,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. A null or empty text is its end id alone. A document
    longer than a sequence is cut; its full pieces are sequences of their own.
    The others are dealt into groups of about ``group`` by a hash of their row
    number, so repeated rows spread like any others; each group is packed by
    best fit and local search. The pieces of bins left underfull are dealt and
    packed again, until one group holds them or after ``ROUNDS`` rounds. No
    rows give no pieces; null ids stay null; other columns are not looked at.
    """
    if not 0 < group < 1 << 20:
        raise ValueError("a group has to be below 2**20 pieces")
    pieces = token_pieces(
        documents, tokenizer_path, id_col=id_col, text_col=text_col, capacity=capacity
    )
    pieces = settle(pieces.select(F.monotonically_increasing_id().alias("row"), "*"), "pieces")
    full = pieces.filter(F.col("length") == capacity)
    done = [full.withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long"))]
    waiting = pieces.filter(F.col("length") < capacity)
    for round_ in range(1, ROUNDS + 1):
        packed = settle(_packed(waiting, group, round_, capacity), f"packed-{round_}")
        waiting = packed.filter("open").drop("sequence_id", "offset", "open")
        if round_ == ROUNDS or waiting.isEmpty():
            done.append(packed.drop("open"))
            break
        done.append(packed.filter("not open").drop("open"))
    return reduce(DataFrame.unionByName, done).drop("row")
