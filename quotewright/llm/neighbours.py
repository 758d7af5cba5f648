"""Nearest neighbours by a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import FloatType

from quotewright.llm.common import forget, map_batches, settle, sweep

NEIGHBOURS = 20
# The tree: vectors it is grown on, children of a node, rows of the table a leaf should hold.
SAMPLE, BRANCHES, LEAF_ROWS, LEAST_SAMPLED = 16_000, 8, 200, 4
ITERATIONS, SEED = 8, 5
# Calibration: queries searched exactly, and the share of their neighbours to be found.
TRIALS, RECALL = 128, 0.95
# Leaves a query sees in the first round, and by how much each round widens them.
FIRST_LEAVES, WIDEN = 4, 8
# Leaves are searched by blocks of whole ones: rows of a block and their bytes, at most,
# and blocks of a table that does not fill so many.
BLOCK_ROWS, BLOCK_BYTES, LEAST_BLOCK_ROWS, BLOCKS = 32_768, 2**24, 512, 32
# Queries and rows of a leaf that one step compares, and candidates held before the best are taken.
PACK_ROWS, STEP_ROWS, HELD = 1024, 1024, 2**16
MOST_TASKS = 2000  # to which blocks are dealt by hash, two a block
SLACK = 1e-9


@dataclass
class Tree:
    """Centers of all nodes; children by node; the number of the leaf, or -1."""

    centers: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return max(self.leaf, default=-1) + 1

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child's, level by level."""
        out = np.zeros(len(rows), dtype=np.int64)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, own = waiting.pop()
            if not len(own):
                continue
            if self.leaf[node] >= 0:
                out[own] = self.leaf[node]
                continue
            children = self.children[node]
            nearest = _nearest(rows[own], self.centers[children])
            waiting += [(child, own[nearest == i]) for i, child in enumerate(children)]
        return out

    @cached_property
    def _paths(self) -> np.ndarray:
        """The nodes from below the root to each leaf, the leaf itself repeated at the end."""
        paths, waiting = {}, [(0, [])]
        while waiting:
            node, path = waiting.pop()
            if self.leaf[node] >= 0:
                paths[self.leaf[node]] = path or [node]
            waiting += [(child, [*path, child]) for child in self.children[node]]
        depth = max(map(len, paths.values()))
        return np.array([path + path[-1:] * (depth - len(path)) for _, path in sorted(paths.items())])

    def orders(self, queries: np.ndarray) -> Iterator[np.ndarray]:
        """All leaves for each query, the node of the best center first.

        It is the order of a priority queue that holds the nodes seen but not
        opened, of all levels, so that the search goes back to wherever the best
        one is. Such a queue gives a leaf once the worst node of its path is the
        best one left, and leaves behind the same node by the rest of their paths.
        """
        numbers = np.arange(len(self.centers), dtype=np.min_scalar_type(len(self.centers)))
        places = np.empty_like(numbers)
        for start in range(0, len(queries), 64):
            for scores in queries[start : start + 64] @ self.centers.T:
                places[np.argsort(-scores, kind="stable")] = numbers
                yield np.lexsort(np.maximum.accumulate(places[self._paths][:, ::-1], axis=1).T)

    def searches(
        self, queries: np.ndarray, count: int, held: dict[int, int] | None = None, wanted: int = 0
    ) -> Iterator[np.ndarray]:
        """Each query's first ``count`` leaves.

        With what each leaf holds they go on until ``wanted`` are held or there
        are no more leaves.
        """
        holds = np.array([held.get(leaf, 0) for leaf in range(self.leaves)]) if held is not None else None
        for order in self.orders(queries):
            enough = 0 if holds is None else int(np.searchsorted(holds[order].cumsum(), wanted)) + 1
            yield order[: max(count, enough)]

    def visits(
        self, queries: np.ndarray, count: int, held: dict[int, int] | None = None, wanted: int = 0
    ) -> list[list[int]]:
        return [found.tolist() for found in self.searches(queries, count, held, wanted)]


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(axis=1) - 2 * rows @ centers.T).argmin(axis=1)


def _split(rows: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """k-means centers of some rows, and the center of each."""
    centers = rows[random.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
    for _ in range(ITERATIONS):
        nearest = _nearest(rows, centers)
        kept = np.unique(nearest)
        centers = np.stack([rows[nearest == i].mean(axis=0) for i in kept])
    return centers, _nearest(rows, centers)


def grow_tree(sample: np.ndarray, leaf_size: int, seed: int = SEED) -> Tree:
    """Split the sample by k-means until a leaf holds ``leaf_size`` of it or cannot be split."""
    random = np.random.default_rng(seed)
    centers, children, leaf, leaves = [sample.mean(axis=0)], [[]], [-1], 0
    waiting = [(0, sample)]
    while waiting:
        node, own = waiting.pop()
        parts = []
        if len(own) > leaf_size:
            found, nearest = _split(own, random)
            parts = [(found[i], own[nearest == i]) for i in range(len(found)) if (nearest == i).any()]
        if len(parts) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        for center, rows in parts:
            children[node].append(len(centers))
            waiting.append((len(centers), rows))
            centers.append(center)
            children.append([])
            leaf.append(-1)
    return Tree(np.stack(centers), children, leaf)


def _vectors(column: pa.Array, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, size).astype(float)


class Leaders:
    """The ``count`` best candidates of each query, none below its floor.

    Candidates come from matrix products; their scores are summed again row by
    row, so equal vectors score equally wherever they stand. Whenever ``HELD``
    are held all but the best are dropped, and floors rise to the last of these.
    """

    def __init__(self, queries: np.ndarray, count: int, floors: np.ndarray | None = None):
        self.queries, self.count = queries, count
        self.floors = np.full(len(queries), -np.inf) if floors is None else floors.copy()
        self.found = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        self.held, self.limit = 0, max(HELD, 4 * count * len(queries))

    def offer(self, asking: np.ndarray, rows: np.ndarray, ids: np.ndarray, leaves: np.ndarray) -> None:
        """Rows as candidates for some of the queries."""
        for start in range(0, len(rows), STEP_ROWS):
            step = slice(start, start + STEP_ROWS)
            self._offer(asking, rows[step], ids[step], leaves[step])

    def _offer(self, asking: np.ndarray, rows: np.ndarray, ids: np.ndarray, leaves: np.ndarray) -> None:
        products, least = self.queries[asking] @ rows.T, self.floors[asking]
        if len(rows) > self.count and not np.isfinite(least).all():
            least = np.maximum(least, np.partition(products, -self.count, axis=1)[:, -self.count])
        below = products < (least - SLACK * np.maximum(1.0, np.abs(least)))[:, None]
        query, row = np.nonzero(~below)
        most = max(1, BLOCK_BYTES // (8 * rows.shape[1]))
        for start in range(0, len(query), most):
            some = slice(start, start + most)
            own, at = asking[query[some]], row[some]
            self.found.append((own, -(rows[at] * self.queries[own]).sum(axis=1), ids[at], leaves[at]))
            self.held += len(own)
            if self.held > self.limit:
                self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query, id, score and leaf of the best so far; ties go to the smaller id."""
        query, rank, ids, leaves = (np.concatenate(column) for column in zip(*self.found))
        order = np.lexsort((ids, rank, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order, place = order[place < self.count], place[place < self.count]
        query, rank, ids, leaves = query[order], rank[order], ids[order], leaves[order]
        last = place == self.count - 1
        self.floors[query[last]] = np.maximum(self.floors[query[last]], -rank[last])
        self.found, self.held = [(query, rank, ids, leaves)], len(query)
        return query, ids, -rank, leaves


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, str]:
    """vec_id, klass (equal for equal vectors) and the vector as bytes; its size and the type of its numbers.

    Null, zero and partly null or non-finite vectors, null ids, and vectors of
    another size than the most frequent one (of two, the smaller) are left out.
    """
    values = F.col("vector")
    elements = table.select(vector_col).schema[0].dataType.elementType
    kind = "<f4" if isinstance(elements, FloatType) else "<f8"
    finite = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).filter(
        F.col("vec_id").isNotNull()
        & values.isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists(values, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    size = sizes[0]["size"] if sizes else 1
    rows = rows.filter(F.size("vector") == size).withColumn(
        "klass", F.concat(F.hex(F.xxhash64("vector")), F.hex(F.xxhash64(F.lit(1), F.reverse("vector"))))
    )

    def start():
        def to_bytes(batch: pa.RecordBatch) -> dict:
            flat = batch["vector"].flatten().to_numpy().astype(kind).reshape(-1, size)
            return {
                "vec_id": batch["vec_id"],
                "klass": batch["klass"],
                "vector": [row.tobytes() for row in flat],
            }

        return to_bytes

    return map_batches(rows, start, "vec_id long, klass string, vector binary"), size, kind


@dataclass
class Blocks:
    """Leaves in blocks: the first block of each leaf and how many it fills; of each block the first and last leaf."""

    first: np.ndarray
    parts: np.ndarray
    low: np.ndarray
    high: np.ndarray


def deal_blocks(counts: dict[int, int], leaves: int, limit: int) -> Blocks:
    """Neighbouring leaves share a block of at most ``limit`` rows; a crowded leaf is cut into blocks of its own."""
    first, parts, low, high, room = [], [], [], [], 0
    for leaf in range(leaves):
        rows = max(1, counts.get(leaf, 0))
        parts.append(-(-rows // limit))
        if rows > room:
            low += [leaf] * parts[-1]
            high += [leaf] * parts[-1]
            room = limit if rows <= limit else 0
        high[-1] = leaf
        first.append(len(low) - parts[-1])
        room -= min(rows, room)
    return Blocks(*(np.array(column, np.int64) for column in (first, parts, low, high)))


ROUNDS = "asker long, round int, vector binary, bits binary"
MEETINGS = pa.schema(
    {
        "block": pa.int64(),
        "asks": pa.int32(),
        "leaf": pa.int64(),
        "id": pa.int64(),
        "vector": pa.binary(),
        "floor": pa.float64(),
        "mask": pa.binary(),
    }
)
FOUND = pa.schema({"asker": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()})
TRUE_LEAVES = pa.schema({"query": pa.int32(), "rank": pa.float64(), "vec_id": pa.int64(), "leaf": pa.int64()})


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        column if isinstance(column, pa.Array) else pa.array(column, kind) for column, kind in zip(columns, schema.types)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def ask_blocks(batches: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    """A row for each query and block that holds leaves of its round, which ``mask`` marks."""
    for whole in batches:
        for start in range(0, whole.num_rows, PACK_ROWS):
            batch = whole.slice(start, PACK_ROWS)
            bits = np.frombuffer(b"".join(batch["bits"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            marks = np.unpackbits(bits, axis=1, count=len(blocks.first)).astype(bool)
            touched = np.flatnonzero(marks.any(axis=0))
            spans = zip(blocks.first[touched], blocks.first[touched] + blocks.parts[touched])
            for block in np.unique(np.concatenate([np.arange(*span) for span in spans])):
                own = marks[:, blocks.low[block] : blocks.high[block] + 1]
                asking = np.flatnonzero(own.any(axis=1))
                own, chosen = own[asking], pa.array(asking)
                yield _batch(
                    MEETINGS,
                    np.full(len(asking), block),
                    np.ones(len(asking), np.int32),
                    blocks.low[block] + own.argmax(axis=1),
                    batch["asker"].take(chosen),
                    batch["vector"].take(chosen),
                    batch["floor"].take(chosen),
                    [row.tobytes() for row in np.packbits(own, axis=1)],
                )


def meet(
    batches: Iterator[pa.RecordBatch], blocks: Blocks, size: int, kind: str, wanted: int
) -> Iterator[pa.RecordBatch]:
    """The best rows of each block for each query that asks it; a block's rows come before its queries."""
    current, waiting, rows = -1, [], None
    for whole in batches:
        number, asks = whole["block"].to_numpy(), whole["asks"].to_numpy()
        ends = [*(np.flatnonzero((np.diff(number) != 0) | (np.diff(asks) != 0)) + 1), whole.num_rows]
        for start, end in zip([0, *ends], ends):
            if start == end:
                continue
            if number[start] != current:
                current, waiting, rows = number[start], [], None
            low = blocks.low[current]
            if not asks[start]:
                batch = whole.slice(start, end - start)
                own = _vectors(batch["vector"], size, kind)
                waiting.append((own, batch["id"].to_numpy(), batch["leaf"].to_numpy()))
                continue
            if waiting:
                rows, ids, leaves = (np.concatenate(column) for column in zip(*waiting))
                waiting = []
                starts = np.searchsorted(leaves, np.arange(low, blocks.high[current] + 2))
            if rows is None:
                continue
            for first in range(start, end, PACK_ROWS):
                batch = whole.slice(first, min(PACK_ROWS, end - first))
                floors = batch["floor"].to_numpy()
                leaders = Leaders(_vectors(batch["vector"], size, kind), wanted, floors)
                mask = np.frombuffer(b"".join(batch["mask"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                marks = np.unpackbits(mask, axis=1, count=len(starts) - 1).astype(bool)
                for place in np.flatnonzero(marks.any(axis=0)):
                    held = slice(starts[place], starts[place + 1])
                    leaders.offer(np.flatnonzero(marks[:, place]), rows[held], ids[held], leaves[held])
                query, found, scores, _ = leaders.best()
                yield _batch(FOUND, batch["id"].take(pa.array(query)), found, scores)


def _leaf_counts(rows: DataFrame) -> dict[int, int]:
    return {row["leaf"]: row["count"] for row in rows.groupBy("leaf").count().collect()}


def _calibrated_visits(
    index: DataFrame, queries: np.ndarray, tree: Tree, kind: str, count: int, recall: float
) -> int:
    """Leaves to visit so that the trial queries find ``recall`` of their true neighbours."""
    size = queries.shape[1]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders, everyone = Leaders(queries, count), np.arange(len(queries))
        for batch in batches:
            if batch.num_rows:
                own = _vectors(batch["vector"], size, kind)
                leaders.offer(everyone, own, batch["vec_id"].to_numpy(), batch["leaf"].to_numpy())
        query, ids, scores, leaves = leaders.best()
        yield _batch(TRUE_LEAVES, query, -scores, ids, leaves)

    nearest = Window.partitionBy("query").orderBy("rank", "vec_id")
    found = (
        index.select("vec_id", "leaf", "vector")
        .mapInArrow(exact, from_arrow_schema(TRUE_LEAVES))
        .withColumn("place", F.row_number().over(nearest))
        .filter(F.col("place") <= count)
        .select("query", "leaf")
        .collect()
    )
    places = [np.argsort(order) for order in tree.orders(queries)]
    needed = np.sort([places[row["query"]][row["leaf"]] + 1 for row in found])
    return int(needed[max(0, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1


def _numbers(rows: list[Row], size: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(row["vector"]) for row in rows), dtype=kind).reshape(-1, size).astype(float)


def _sampled(kept: DataFrame, rows: int) -> list[Row]:
    """The ``SAMPLE`` vectors of the least hashes.

    Each task of a limited sort sends the driver as many rows as the limit, so
    hashes that are surely too large are left out before it.
    """
    number = F.xxhash64("vec_id", "klass")
    some = kept.filter(number <= int(2**64 * min(1.0, 1.25 * SAMPLE / rows)) - 2**63 - 1)

    def least(frame: DataFrame) -> list[Row]:
        return frame.orderBy(number, "vec_id").limit(SAMPLE).select("vector").collect()

    found = least(some)
    return found if len(found) == min(SAMPLE, rows) else least(kept)


def nearest_neighbours(
    table: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    count: int = NEIGHBOURS,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``count`` nearest found by largest inner product.

    Queries are the rows whose id is divisible by ``every``; candidates all
    other ids. Ties go to the smaller id; with fewer candidates all are given.
    Invalid vectors (see ``valid_vectors``) take no part. Rows that repeat an id
    and vector are one; rows of an id with different vectors are all candidates
    and queries, never each other's neighbours, and the best score of an id
    counts. No rows give none; other columns are not looked at.

    The tree grows on at most ``SAMPLE`` vectors; all rows are placed in its
    leaves. Equal vectors are one class: any query needs the ``count`` + 1
    smallest ids of it at most, and equal queries are searched once. ``TRIALS``
    queries are compared with all rows, and the visits are widened until they
    would find ``recall`` of their neighbours; all queries visit as many leaves,
    and more where these hold fewer than ``count`` + 1 ids. Leaves are searched by
    blocks, to each of which go its rows and a row for each query that has leaves
    in it; a crowded leaf is cut into several.
    """
    vectors, size, kind = valid_vectors(table, id_col, vector_col)
    wanted = count + 1
    first = Window.partitionBy("klass").orderBy("vec_id")
    kept = settle(
        vectors.dropDuplicates(["klass", "vec_id"])
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= wanted)
        .drop("place"),
        "vectors",
    )
    sweep(table.sparkSession)
    rows = kept.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not rows:
        return table.sparkSession.createDataFrame([], schema)
    sample = _numbers(_sampled(kept, rows), size, kind)
    tree = grow_tree(sample, max(LEAST_SAMPLED, LEAF_ROWS * len(sample) // rows))
    given = table.sparkSession.sparkContext.broadcast(tree)

    def placing():
        def place(batch: pa.RecordBatch) -> dict:
            leaf = given.value.place(_vectors(batch["vector"], size, kind))
            return {"vec_id": batch["vec_id"], "vector": batch["vector"], "leaf": leaf.tolist()}

        return place

    index = settle(map_batches(kept, placing, "vec_id long, vector binary, leaf long"), "index")
    forget(kept)
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    queries = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), "klass", "vector")
    classes = settle(
        queries.select("klass", "vector").dropDuplicates(["klass"]).withColumn("asker", F.monotonically_increasing_id()),
        "classes",
    )
    trials = classes.orderBy(F.xxhash64("klass"), "klass").limit(TRIALS).select("vector").collect()
    leaves = _calibrated_visits(index, _numbers(trials, size, kind), tree, kind, wanted, recall)

    # An id with vectors in several leaves counts in one of them only.
    ids = _leaf_counts(index.groupBy("vec_id").agg(F.min("leaf").alias("leaf")))

    # A round's leaves are marked by a bit each: a query and a leaf never make a row of their own.
    def visiting():
        def visit(batch: pa.RecordBatch) -> dict:
            asking, rounds, bits = [], [], []
            searches = given.value.searches(_vectors(batch["vector"], size, kind), leaves, ids, wanted)
            for query, order in enumerate(searches):
                number, start, reach = 0, 0, FIRST_LEAVES
                while start < len(order):
                    marks = np.zeros(given.value.leaves, bool)
                    marks[order[start:reach]] = True
                    asking.append(query)
                    rounds.append(number)
                    bits.append(np.packbits(marks).tobytes())
                    number, start, reach = number + 1, reach, reach * WIDEN
            places = pa.array(asking, pa.int64())
            return {
                "asker": batch["asker"].take(places),
                "round": rounds,
                "vector": batch["vector"].take(places),
                "bits": bits,
            }

        return visit

    visits = settle(map_batches(classes.select("asker", "vector"), visiting, ROUNDS), "visits")
    limit = min(BLOCK_ROWS, BLOCK_BYTES // (8 * size), max(LEAST_BLOCK_ROWS, rows // BLOCKS))
    blocks = deal_blocks(_leaf_counts(index), tree.leaves, max(1, limit))
    dealt = table.sparkSession.createDataFrame(
        [(leaf, int(blocks.first[leaf]), int(blocks.parts[leaf])) for leaf in range(tree.leaves)],
        "leaf long, first long, parts long",
    )
    nothing = {name: F.lit(None).cast(kind_) for name, kind_ in (("floor", "double"), ("mask", "binary"))}
    held = (
        index.join(F.broadcast(dealt), "leaf")
        .withColumn("block", F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")))
        .select("block", F.lit(0).alias("asks"), "leaf", F.col("vec_id").alias("id"), "vector")
        .withColumns(nothing)
    )
    shared = table.sparkSession.sparkContext.broadcast(blocks)

    def search(asked: DataFrame) -> DataFrame:
        # Rows and queries of a block go to its task one by one, the rows first.
        asked = asked.mapInArrow(lambda batches: ask_blocks(batches, shared.value), from_arrow_schema(MEETINGS))
        return (
            held.unionByName(asked)
            .repartition(min(2 * len(blocks.low), MOST_TASKS), "block")
            .sortWithinPartitions("block", "asks", "leaf")
            .mapInArrow(lambda batches: meet(batches, shared.value, size, kind, wanted), from_arrow_schema(FOUND))
        )

    nearest = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")

    def leading(found: DataFrame) -> DataFrame:
        return (
            found.withColumn("place", F.row_number().over(nearest))
            .filter(F.col("place") <= wanted)
            .drop("place")
        )

    # What a round finds has to beat the end of the list so far. A round sees a few times
    # the leaves seen before it, so it returns about as many rows as the first one.
    full = F.when(F.count("*") >= wanted, F.min("score")).otherwise(float("-inf"))
    last = visits.agg(F.max("round")).first()[0] or 0
    top = None
    for number in range(last + 1):
        asked = visits.filter(F.col("round") == number)
        if top is None:
            top = search(asked.withColumn("floor", F.lit(float("-inf"))))
        else:
            asked = asked.join(top.groupBy("asker").agg(full.alias("floor")), "asker", "left")
            asked = asked.withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
            top = top.unionByName(search(asked))
        top = settle(leading(top), "leading")
        sweep(table.sparkSession)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.select("query_id", "klass")
        .distinct()
        .join(top.join(classes.select("asker", "klass"), "asker"), "klass")
        .filter(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )
