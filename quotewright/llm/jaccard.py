"""Exact Jaccard join of word shingles by a token-group matrix.

Texts of equal words are one node. A node links with another only if
three quarters of its tokens are found in other nodes too; those found in no
other are counted by an exchange of sorted tokens, and only the nodes that pass,
the candidates, go on. Near copies among them are gathered first: nodes that
share a min-hash are checked against the most central of them, and the verified
links make groups of similar documents. What links groups is then found exactly:
only tokens of several groups count, a prefix of each set by their order meets
the prefixes of other groups, a group keeps the union of its members' tokens
with a mask of members per token, a query is bounded against the union, and only
groups that pass are opened.

A pair of the threshold t shares a token of both prefixes of n − ⌈tn⌉ + 1
tokens, whatever the order of tokens is, as long as it is one order. Pairs
inside a group are linked already. So every link between groups is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructType

from quotewright.llm.common import WORD, forget, row_key, settle, spare_names
from quotewright.llm.dedup import golomb_decode, golomb_encode, owner_start

SHINGLE, PERCENT = 5, 75
KEYS = 6
# Members a group has on average. Its matrix is cut into parts of as many members
# as a token's mask has bits.
MEMBERS = 128
# Tokens a task sends together, tokens of an owner on average, queries of a group that go together.
CHUNK_TOKENS, OWNER_TOKENS, PACK = 1 << 20, 1 << 21, 1000
FEWEST_OWNERS = 24
# Bits of a token in the exchange beyond those that number all tokens: one of 2**6
# is taken for another one by chance. That lets a node through, and drops none.
SPARE_BITS = 6
# Bits of the filter that says which texts are needed again.
FILTER_BITS = 24
# Bits of the filter that says which tokens several groups have.
TOKEN_FILTER_BITS = 26
CACHE_WORDS = 300_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
ODD = np.array(
    [0x9E3779B97F4A7C15 * (2 * i + 1) + 2 * i & 0xFFFFFFFFFFFFFFFF | 1 for i in range(1, KEYS + 1)],
    dtype=np.uint64,
)


def words_of(text: pa.Scalar) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return (text.as_py() or b"").lower().split()  # ASCII only, both


class Shingles:
    """Distinct shingles of texts as sorted 64-bit hashes.

    Words are hashed once and mixed in order, so a shingle costs a few array
    operations. Two different shingles of a corpus have one hash with a chance
    of 2**-64 a pair.
    """

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        own = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(own))
        count = len(own) - size + 1
        out = own[:count] + np.uint64(size)
        for offset in range(1, size):
            out = (out ^ (out >> np.uint64(29))) * FACTOR + own[offset : count + offset]
        out = (out ^ (out >> np.uint64(32))) * FACTOR
        return np.unique(out ^ (out >> np.uint64(29)))


def _digest(words: list[bytes]) -> bytes | None:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, field.type) for c, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _digests(rows: DataFrame) -> DataFrame:
    """doc_id, text_hash, the digest of the words of every text and how many there are."""
    kinds = _arrow("doc_id long, text_hash long, digest binary, words long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], []
            for words in map(words_of, batch["text"].cast(pa.binary())):
                found.append(_digest(words))
                counts.append(len(words))
            yield _batch(kinds, batch["doc_id"], batch["text_hash"], found, counts)

    return rows.mapInArrow(run, "doc_id long, text_hash long, digest binary, words long")


def _bit(column: Column, bits: int = FILTER_BITS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << bits)) + 1


def _filter(values: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit per hash of the values of one column; of the same size for any number of them."""
    bit = _bit(F.col(values.columns[0]), bits)
    rows = (
        values.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    width = 32768 // 8
    for row in rows:
        start = (row["bucket"] - 1) * width
        out[start : start + width] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def _needed_texts(rows: DataFrame, first_ids: DataFrame):
    """A reader of the rows whose texts a filter of ids knows: batches of words.

    Texts that the filter does not know are not read by Python.
    """
    given = rows.sparkSession.sparkContext.broadcast(_filter(first_ids.select("first_id")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[bytes]]]:
        for batch in batches:
            bits = batch["bit"].to_numpy() - 1
            wanted = (given.value[bits >> 3] >> (bits & 7)) & 1
            texts = batch["text"].filter(pa.array(wanted.astype(bool))).cast(pa.binary())
            yield [words for words in map(words_of, texts) if words]

    return rows.select(_bit(F.col("doc_id")).alias("bit"), "text"), read


# --- candidates: nodes with enough tokens that others have too -----------------

MESSAGE = (
    "sender long, owner int, count int, rice int, highs binary, lows binary, holders binary, "
    "digests binary, sizes binary, found binary"
)
SEVERAL = np.uint32(0xFFFFFFFF)


def _token_messages(rows: DataFrame, first_ids: DataFrame, size: int, owners: int, token_bits: int) -> DataFrame:
    """Each task's tokens, sorted and Golomb-coded, to their owners, with who holds each.

    A token that several nodes of a task hold is sent once, without a holder:
    the task has counted it for them. At the end of a chunk comes its list of
    nodes with their sizes and those counts.
    """
    kinds = _arrow(MESSAGE)
    starts = [owner_start(owner, owners, token_bits) for owner in range(owners + 1)]
    texts, read = _needed_texts(rows, first_ids)

    def chunk(held: dict[bytes, np.ndarray], sender: int) -> pa.RecordBatch:
        sizes = np.array([len(tokens) for tokens in held.values()], dtype="<u4")
        holders = np.repeat(np.arange(len(held), dtype=np.uint32), sizes)
        tokens = np.concatenate(list(held.values())) >> np.uint64(64 - token_bits)
        order = np.argsort(tokens, kind="stable")
        tokens, holders = tokens[order].view(np.int64), holders[order]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = tokens[1:] != tokens[:-1]
        firsts = np.flatnonzero(new)
        several = np.diff(firsts, append=len(tokens)) > 1
        found = np.bincount(holders[np.repeat(several, np.diff(firsts, append=len(tokens)))], minlength=len(held))
        own, who = tokens[firsts], np.where(several, SEVERAL, holders[firsts]).astype("<u4")
        cuts = np.searchsorted(own, starts)
        columns: list[list] = [[] for _ in kinds]
        for owner in np.flatnonzero(np.diff(cuts)):
            low, high = cuts[owner], cuts[owner + 1]
            code = golomb_encode(own[low:high], starts[owner], starts[owner + 1] - starts[owner])
            small = who[low:high].astype("<u2") if len(held) < 0xFFFF else who[low:high]
            row = (sender, int(owner), int(high - low), *code, small.tobytes(), None, None, None)
            for column, value in zip(columns, row):
                column.append(value)
        last = (sender, -1, len(held), 0, None, None, None, b"".join(held), sizes.tobytes(), found.astype("<u4").tobytes())
        for column, value in zip(columns, last):
            column.append(value)
        return _batch(kinds, *columns)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        sender, held, total = TaskContext.get().partitionId() << 32, {}, 0
        for texts in read(batches):
            for words in texts:
                digest = _digest(words)
                if digest not in held:
                    held[digest] = shingles(words)
                    total += len(held[digest])
                    if total >= CHUNK_TOKENS:
                        yield chunk(held, sender)
                        sender, held, total = sender + 1, {}, 0
        if held:
            yield chunk(held, sender)

    return texts.mapInArrow(send, MESSAGE)


def _token_replies(messages: DataFrame, owners: int, token_bits: int) -> DataFrame:
    """For each message the holders of tokens that other messages have too, and how many of them."""
    schema = "sender long, holders binary, found binary"
    kinds = _arrow(schema)

    def answer(table: pa.Table) -> pa.Table:
        low = owner_start(table["owner"][0].as_py(), owners, token_bits)
        sent, who = [], []
        for place in range(table.num_rows):
            code = (table[name][place].as_py() for name in ("count", "rice", "highs", "lows"))
            sent.append(golomb_decode(*code, low))
            held = table["holders"][place].as_buffer()
            wide = held.size == 4 * len(sent[-1])
            who.append((np.frombuffer(held, dtype="<u4" if wide else "<u2"), SEVERAL if wide else 0xFFFF))
        ends = np.cumsum([len(values) for values in sent])[:-1]
        tokens = np.concatenate(sent)
        del sent
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        twice = np.zeros(len(tokens), dtype=bool)
        twice[1:] = tokens[1:] == tokens[:-1]
        twice[:-1] |= twice[1:]
        common = np.empty_like(twice)
        common[order] = twice
        holders, found = [], []
        for (own, several), marks in zip(who, np.split(common, ends)):
            ids, counts = np.unique(own[marks & (own != several)], return_counts=True)
            holders.append(ids.astype("<u4").tobytes())
            found.append(counts.astype("<u4").tobytes())
        return pa.table([table["sender"], pa.array(holders, pa.binary()), pa.array(found, pa.binary())], schema=kinds)

    asked = messages.filter("owner >= 0").select("sender", "owner", "count", "rice", "highs", "lows", "holders")
    return asked.groupBy("owner").applyInArrow(answer, schema)


def _token_counts(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """digest, n (tokens) and common (tokens that other nodes have too) of each node sent."""
    schema = "digest binary, n long, common long"
    kinds = _arrow(schema)

    def add(lists: pa.Table, answers: pa.Table) -> pa.Table:
        digests, sizes, found = [], [], []
        for row in lists.to_pylist():
            own = np.frombuffer(row["found"], dtype="<u4").astype(np.int64)
            for part in answers.to_pylist():
                own[np.frombuffer(part["holders"], dtype="<u4")] += np.frombuffer(part["found"], dtype="<u4")
            digests += [row["digests"][16 * i : 16 * i + 16] for i in range(row["count"])]
            sizes.append(np.frombuffer(row["sizes"], dtype="<u4").astype(np.int64))
            found.append(own)
        columns = [pa.array(digests, pa.binary()), np.concatenate(sizes), np.concatenate(found)] if digests else [[], [], []]
        return pa.table(columns, schema=kinds)

    lists = messages.filter("owner < 0").select("sender", "count", "digests", "sizes", "found")
    counted = lists.groupBy("sender").cogroup(replies.groupBy("sender")).applyInArrow(add, schema)
    # What the filter lets through by chance may be sent twice.
    return counted.groupBy("digest").agg(F.max("n").alias("n"), F.max("common").alias("common"))


def _sets(rows: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """node, n and tokens of the needed nodes (node, digest, first_id), from their texts."""
    kinds = _arrow("digest binary, tokens binary")
    texts, read = _needed_texts(rows, needed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for lists in read(batches):
            yield _batch(kinds, [_digest(words) for words in lists], [shingles(words).tobytes() for words in lists])

    found = texts.mapInArrow(run, "digest binary, tokens binary")
    # Copies of a set are put together in each task before the shuffle.
    distinct = found.groupBy("digest").agg(F.first("tokens").alias("tokens"))
    return distinct.join(needed.select("node", "digest", "n"), "digest").select("node", "n", "tokens")


def _tokens(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype="<u8")


def linked(shared, first, second, percent: int = PERCENT):
    """100·|A∩B| ≥ percent·|A∪B|, in whole numbers."""
    return (100 + percent) * shared >= percent * (first + second)


# --- groups of near copies ----------------------------------------------------


def _keys(sets: DataFrame) -> DataFrame:
    """node, n and its min-hashes, a row each."""
    kinds = _arrow("node long, n long, keys array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [[int((_tokens(value) * o).min().view(np.int64)) for o in ODD] for value in batch["tokens"]]
            yield _batch(kinds, batch["node"], batch["n"], keys)

    keyed = sets.mapInArrow(run, "node long, n long, keys array<long>")
    return keyed.select("node", "n", F.posexplode("keys").alias("slot", "key"))


def _pivots(sets: DataFrame, percent: int) -> DataFrame:
    """(node, pivot): the most central of the nodes that share a min-hash with it.

    Central is who shares most min-hashes with others. A node has one pivot at
    most, above it in that order, so links to pivots have no cycles. Keys are
    counted in tables of their own, so the joins with the nodes of a hot key
    can be split.
    """
    keyed = settle(_keys(sets), "keys")
    shared = settle(
        keyed.groupBy("slot", "key").agg((F.count("*") - 1).alias("others")).filter("others > 0"), "shared"
    )
    met = settle(keyed.join(shared, ["slot", "key"]), "met")
    weights = settle(met.groupBy("node").agg(F.sum("others").alias("weight")), "weights")
    weighed = settle(met.join(weights, "node").select("slot", "key", "node", "n", "weight"), "weighed")
    tops = settle(weighed.groupBy("slot", "key").agg(F.max(F.struct("weight", "node", "n")).alias("top")), "tops")
    sizes = linked(F.least("n", "top.n"), F.col("n"), F.col("top.n"), percent)
    pairs = weighed.join(tops, ["slot", "key"]).filter((F.col("top.node") != F.col("node")) & sizes)
    best = pairs.groupBy("node").agg(F.max("top").alias("top"))
    result = settle(best.select("node", F.col("top.node").alias("pivot")), "pivots")
    for frame in (keyed, shared, met, weights, weighed, tops):
        forget(frame)
    return result


def _verified(links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs of the threshold or above."""
    kinds = _arrow("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for own, other in zip(batch["tokens"], batch["others"]):
                a, b = _tokens(own), _tokens(other)
                kept.append(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))
            mask = pa.array(kept, pa.bool_())
            yield _batch(kinds, batch["node"].filter(mask), batch["pivot"].filter(mask))

    pivots = links.select(F.col("pivot").alias("node")).distinct()
    others = sets.join(pivots, "node", "left_semi").select(F.col("node").alias("pivot"), F.col("tokens").alias("others"))
    own = links.join(sets.select("node", "tokens"), "node")
    return own.join(others, "pivot").select("node", "pivot", "tokens", "others").mapInArrow(run, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node it is connected with, for all nodes of (a, b).

    Alternating large and small stars. Each step takes minima per node and a
    join, so a node with very many neighbours needs no task of its own.
    """
    edges = settle(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large, "large")
        last = edges
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        edges = settle(small.union(least.select("a", "m")).distinct(), "small")
        forget(large)
        forget(last)
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (new := tuple(row)) == state:
            return edges.withColumnsRenamed({"a": "node", "b": "root"})
        state = new


# --- links between groups -----------------------------------------------------


def _listed(sets: DataFrame) -> DataFrame:
    """The columns of a frame with its tokens, a row for each token."""
    rest = [name for name in sets.columns if name != "tokens"]
    schema = StructType([sets.schema[name] for name in rest]).add("tokens", ArrayType(LongType()))
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_tokens(value).view(np.int64) for value in batch["tokens"]]
            ends = pa.array(np.cumsum([0, *map(len, values)]).astype(np.int32))
            flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int64))
            yield _batch(kinds, *(batch[name] for name in rest), pa.ListArray.from_arrays(ends, flat))

    return sets.mapInArrow(run, schema).select(*rest, F.explode("tokens").alias("token"))


def _contested(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of (node, root, n, tokens) the nodes with enough tokens of several roots, and these tokens.

    A link leaves a root only by tokens that another root has too. Nodes with
    too few of them go; a filter of bounded size tells, so a few may stay by
    chance. Without them tokens are contested no more, so that is done again as
    long as half of the nodes go. ``sets`` is a settled frame, and deleted.
    """
    left, count = sets, sets.count()
    while True:
        tokens = settle(
            _listed(left.select("root", "tokens"))
            .groupBy("token")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .filter("low < high")
            .select("token"),
            "contested",
        )
        kept = settle(_with_enough(left, tokens, percent), "open-sets")
        forget(left)
        before, count, left = count, kept.count(), kept
        if 2 * count > before or not count:
            return left, tokens
        forget(tokens)


def _with_enough(sets: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The sets of which the percentage or more passes a filter of tokens."""
    folded = tokens.select(F.pmod("token", F.lit(1 << TOKEN_FILTER_BITS)).alias("bit"))
    place = F.col("bit") + 1
    rows = (
        folded.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    marks = np.zeros((1 << TOKEN_FILTER_BITS) // 8, dtype=np.uint8)
    for row in rows:
        start = (row["bucket"] - 1) * 4096
        marks[start : start + 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    given = sets.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64((1 << TOKEN_FILTER_BITS) - 1)
        for batch in batches:
            kept = []
            for value in batch["tokens"]:
                bits = (_tokens(value) & low).astype(np.int64)
                held = int(((given.value[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1).sum())
                kept.append(100 * held >= percent * len(bits))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return sets.mapInArrow(run, sets.schema)


MASK_BITS = 64


def _matrix(members: pa.Table) -> list[tuple]:
    """The union of the members' tokens, each with a mask of members; in parts of as many members as a mask has bits."""
    out = []
    for start in range(0, members.num_rows, MASK_BITS):
        part = members.slice(start, MASK_BITS)
        sets = [_tokens(value) for value in part["tokens"]]
        union, place = np.unique(np.concatenate(sets), return_inverse=True)
        masks = np.zeros(len(union), dtype="<u8")
        bits = np.repeat(np.uint64(1) << np.arange(len(sets), dtype=np.uint64), [len(s) for s in sets])
        np.bitwise_or.at(masks, place, bits)
        sizes = np.array([len(s) for s in sets])
        out.append((part["node"].to_numpy(), part["root"].to_numpy(), sizes, union, masks))
    return out


def _opened(asked: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of queries with the members of their group that have another root.

    The group's matrix is made once for all queries of a pack. A query shares
    at most its overlap with the union with any member; where that is too
    little for the smallest member the group stays closed.
    """
    kinds = _arrow("a long, b long")

    def run(queries: pa.Table, group: pa.Table) -> pa.Table:
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        own_rows = list(zip(queries["node"].to_pylist(), queries["root"].to_pylist(), queries["tokens"]))
        for ids, roots, sizes, union, masks in _matrix(group) if own_rows else ():
            for node, root, value in own_rows:
                own = _tokens(value)
                at = np.searchsorted(union, own)
                at = at[union[np.minimum(at, len(union) - 1)] == own]
                if not linked(len(at), len(own), sizes.min(), percent):
                    continue
                bits = np.unpackbits(masks[at].view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
                shared = bits.sum(axis=0, dtype=np.int64)[: len(sizes)]
                met = np.flatnonzero(linked(shared, len(own), sizes, percent) & (roots != root))
                first.append(np.full(len(met), node, dtype=np.int64))
                second.append(ids[met])
        return pa.table([np.concatenate(first), np.concatenate(second)], schema=kinds)

    keys = ["family", "part", "pack"]
    return asked.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(run, "a long, b long")


def _between(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all links between nodes of different roots, of (node, root, family, n, tokens).

    Groups are made of nodes of one family, similar ones that need not link.
    """
    left, contested = _contested(sets, percent)
    held = _listed(left.select("node", "root", "n", "tokens")).join(contested, "token", "left_semi")
    held = settle(held, "held")
    # Tokens that the same nodes hold are one to the join: count and two sums of hashes name them.
    classes = settle(
        held.groupBy("token").agg(
            F.count("*").alias("holders"),
            F.bit_xor(F.xxhash64("node")).alias("first_sum"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("second_sum"),
        ),
        "token-classes",
    )
    ranked = held.join(classes, "token")
    # Tokens of one root only come first in the order, then those of the fewest nodes.
    order = Window.partitionBy("node").orderBy("holders", "first_sum", "second_sum", "token")
    every = Window.partitionBy("node")
    needed = F.ceil(percent * F.col("n") / F.lit(100))
    prefix = (
        ranked.withColumn("place", F.row_number().over(order))
        .withColumn("open", F.count("*").over(every))
        .withColumn("reach", F.col("open") - F.col("place") + 1)
        .filter(F.col("reach") >= needed)
    )
    parts = left.groupBy("family").agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    dealt = settle(
        left.join(parts, "family").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).drop("parts"), "dealt"
    )
    named = ("holders", "first_sum", "second_sum")
    meeting = settle(
        prefix.groupBy("node", *named)
        .agg(F.max("reach").alias("reach"))
        .join(dealt.select("node", "root", "family", "part", "n"), "node"),
        "meeting",
    )
    groups = meeting.groupBy(*named, F.col("family").alias("other"), F.col("part").alias("other_part")).agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max("reach").alias("most_reach"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    groups = settle(groups, "class-groups")
    # A pair of groups is asked about from one side, a group also about itself.
    once = (F.col("family") < F.col("other")) | (
        (F.col("family") == F.col("other")) & (F.col("part") <= F.col("other_part"))
    )
    apart = (F.col("low") != F.col("root")) | (F.col("high") != F.col("root"))
    near = (percent * F.col("least") <= 100 * F.col("n")) & (100 * F.col("most") >= percent * F.col("n"))
    # What a link shares, percent / (100 + percent) of both sizes, has to come after the first shared token.
    enough = percent * (F.col("n") + F.col("least")) <= (100 + percent) * F.least("reach", "most_reach")
    candidates = settle(
        meeting.join(groups, list(named))
        .filter(once & apart & near & enough)
        .select("node", F.col("other").alias("family"), F.col("other_part").alias("part"))
        .distinct(),
        "candidates",
    )
    packs = candidates.groupBy("family", "part").agg(F.ceil(F.count("*") / PACK).alias("packs"))
    packs = settle(packs, "packs")
    sent = ("family", "part", "pack", "node", "root", "tokens")
    asked = (
        candidates.join(packs, ["family", "part"])
        .withColumn("pack", F.pmod(F.xxhash64("node", F.lit(2)), F.col("packs")))
        .join(dealt.select("node", "root", "tokens"), "node")
        .select(*sent)
    )
    # Names of their own, for both sides of the cogroup come from one table.
    members = (
        dealt.join(packs, ["family", "part"])
        .withColumn("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.col("packs") - 1)))
        .select(*(F.col(name).alias(name) for name in sent))
    )
    outer = settle(_opened(asked, members, percent), "outer")
    for frame in (left, contested, held, classes, dealt, meeting, groups, candidates, packs):
        forget(frame)
    return outer


def jaccard_components(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two texts link if 100·|A∩B| ≥ percent·|A∪B| of their sets of shingles;
    component_id is the smallest id reachable by links. Texts of fewer words
    than a shingle have one, the whole sequence. Null texts and texts without
    words have none, link with nothing and are components of their own.
    Repeated rows are rows of one node. Null ids are not the smallest; a
    component without any other has a null id. No rows give none; other
    columns are not looked at.

    Nothing is compared within a set of copies or a group that is linked
    already, nor for tokens that only one group has; each pass over the texts
    keeps a task's state of bounded size.
    """
    return _components(documents, id_col, text_col, size, percent).select("doc_id", "n_shingles", "component_id")


def keep_one(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One document of each component, the one of the smallest id, with its own columns.

    Of rows of one id and text, one stays; texts without words all stay.
    """
    key, place = spare_names(documents, "key", "place")
    hashed = F.xxhash64(text_col)
    found = _components(documents, id_col, text_col, size, percent).filter("root is not null")
    kept = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("doc_id"), F.col("kept.text_hash").alias("text_hash"))
    kept = kept.select(row_key("doc_id", "text_hash").alias(key))
    worded = F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    keyed = documents.filter(worded).withColumn(place, hashed).withColumn(key, row_key(id_col, place))
    among = Window.partitionBy(key).orderBy(F.xxhash64(*documents.columns))
    first = (
        keyed.join(kept, key, "left_semi").withColumn(place, F.row_number().over(among)).filter(F.col(place) == 1)
    )
    return first.select(documents.columns).unionByName(documents.filter(~worded))


def _components(documents: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and root, which names the component."""
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")
    )
    texts = settle(_digests(rows), "digests")
    classes = settle(
        texts.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.max("words").alias("words")),
        "classes",
    )
    words = classes.agg(F.sum("words").alias("words")).first()["words"] or 0
    owners = max(FEWEST_OWNERS, words // OWNER_TOKENS)
    token_bits = min(62, max(24, int(words).bit_length() + SPARE_BITS))
    messages = settle(_token_messages(rows, classes, size, owners, token_bits), "token-messages")
    replies = _token_replies(messages, owners, token_bits)
    nodes = settle(
        _token_counts(messages, replies)
        .join(classes.drop("words"), "digest")
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    forget(messages)
    open_nodes = nodes.filter(100 * F.col("common") >= percent * F.col("n"))
    sets = settle(_sets(rows, open_nodes, size), "sets")
    links = _pivots(sets, percent)
    inner = settle(_verified(links, sets, percent), "inner")
    known = connected(inner)
    forget(inner)
    # A node's family is its root, or that of the pivot it is similar to.
    far = known.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    families = links.join(far, "pivot", "left").select("node", F.coalesce("pivot_root", "pivot").alias("family"))
    rooted = (
        sets.join(known, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(families, "node", "left")
        .withColumn("family", F.coalesce("family", "root"))
    )
    # Sets of a group lie together, so a task counts their tokens once; a large group is cut.
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), words // CHUNK_TOKENS)
    rooted = settle(rooted.select("node", "root", "family", "n", "tokens").repartitionByRange(parts, "root", "node"), "rooted")
    forget(sets)
    forget(links)
    outer = _between(rooted, percent)
    # A link to the root stands for all links within a group.
    roots = connected(known.select(F.col("node").alias("a"), F.col("root").alias("b")).union(outer))
    forget(outer)
    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_digest = labelled.join(smallest, "root").select("digest", F.col("n").alias("n_shingles"), "component_id", "root")
    names = ("doc_id", "text_hash", "n_shingles", "component_id", "root")
    full = texts.filter("digest is not null").join(settle(by_digest, "by-digest"), "digest").select(*names)
    empty = texts.filter("digest is null").select(
        "doc_id", "text_hash", F.lit(0).cast("long").alias("n_shingles"),
        F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"),
    )
    return full.unionByName(empty)

