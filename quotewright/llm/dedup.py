"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each task sends the sorted fingerprints of its rows, Golomb-coded, to the owners
of their ranges. An owner answers each message with a bitmap of those that
others sent too. Only rows with such a fingerprint, the suspects, are shuffled
with their texts, and their bytes are compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quotewright.llm.common import settle, spare_names

# Bits of a fingerprint beyond those that number the rows: one pair of different
# texts in 2**12 rows meets by chance, and its bytes are compared for nothing.
SPARE_BITS = 12
# Fingerprints of a message round, and of an owner, at most on average.
ROUND_ROWS, OWNER_ROWS = 1 << 18, 1 << 22
FEWEST_OWNERS = 64
# Bits of the suspects' filter for each suspect, and of the whole filter at most.
SUSPECT_BITS, FILTER_BITS = 16, 27
BUCKET_BITS = 32768  # Fixed value: bits of a bitmap of Spark's

MESSAGE = "sender long, owner int, count int, rice int, highs binary, lows binary, repeated binary"


def golomb_encode(values: np.ndarray, low: int, width: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct values of [low, low + width) as gaps in a Golomb code.

    The divisor is a power of two near 0.69 times the mean gap. Quotients are
    unary in one string of bits, remainders stand in another.
    """
    gaps = np.diff(values, prepend=low)
    rice = max(0, int(math.log2(max(1.0, 0.69 * width / len(values)))))
    ends = np.cumsum((gaps >> rice) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    rest = ((gaps[:, None] >> np.arange(rice)) & 1).astype(np.uint8)
    return rice, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def golomb_decode(count: int, rice: int, highs: bytes, lows: bytes, low: int) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(highs, dtype=np.uint8)))
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.int64) << rice
    rest = np.unpackbits(np.frombuffer(lows, dtype=np.uint8))[: count * rice].reshape(count, rice)
    for bit in range(rice):
        gaps += rest[:, bit].astype(np.int64) << bit
    return low + np.cumsum(gaps)


def owner_start(owner, owners: int, bits: int):
    """The first fingerprint an owner has."""
    return (owner << bits) // owners


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _messages(prints: DataFrame, owners: int, bits: int) -> DataFrame:
    """The messages of every task to every owner it has fingerprints for."""
    schema = _arrow(MESSAGE)
    starts = [owner_start(owner, owners, bits) for owner in range(owners + 1)]

    def message(values: np.ndarray, sender: int) -> pa.RecordBatch:
        own, counts = np.unique(values, return_counts=True)
        cuts = np.searchsorted(own, starts)
        columns: list[list] = [[] for _ in schema]
        for owner in np.flatnonzero(np.diff(cuts)):
            low, high = cuts[owner], cuts[owner + 1]
            code = golomb_encode(own[low:high], starts[owner], starts[owner + 1] - starts[owner])
            again = np.packbits(counts[low:high] > 1).tobytes()
            for column, value in zip(columns, (sender, int(owner), int(high - low), *code, again)):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch["fingerprint"].to_numpy())
            size += batch.num_rows
            if size >= ROUND_ROWS:
                yield message(np.concatenate(held), sender)
                sender, held, size = sender + 1, [], 0
        if size:
            yield message(np.concatenate(held), sender)

    return prints.select("fingerprint").mapInArrow(send, MESSAGE)


def _replies(messages: DataFrame, owners: int, bits: int) -> DataFrame:
    """sender, owner and the bitmap of the message's fingerprints that are found more than once."""
    schema = _arrow("sender long, owner int, duplicate binary")

    def answer(table: pa.Table) -> pa.Table:
        low = owner_start(table["owner"][0].as_py(), owners, bits)
        rows = table.select(["count", "rice", "highs", "lows"]).to_pydict()
        sent = [golomb_decode(*row, low) for row in zip(*rows.values())]
        seen = [
            1 + np.unpackbits(np.frombuffer(flags.as_py(), dtype=np.uint8))[: len(values)]
            for flags, values in zip(table["repeated"], sent)
        ]
        _, place = np.unique(np.concatenate(sent), return_inverse=True)
        found = np.bincount(place, weights=np.concatenate(seen))[place] > 1
        ends = np.cumsum([len(values) for values in sent])[:-1]
        bitmaps = [np.packbits(part).tobytes() for part in np.split(found, ends)]
        return pa.table([table["sender"], table["owner"], pa.array(bitmaps, pa.binary())], schema=schema)

    return messages.groupBy("owner").applyInArrow(answer, "sender long, owner int, duplicate binary")


def _suspects(messages: DataFrame, replies: DataFrame, owners: int, bits: int) -> DataFrame:
    """The fingerprints a sender finds marked in the answers to its messages."""
    schema = _arrow("fingerprint long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low = owner_start(row["owner"], owners, bits)
                own = golomb_decode(row["count"], row["rice"], row["highs"], row["lows"], low)
                marks = np.unpackbits(np.frombuffer(row["duplicate"], dtype=np.uint8))[: len(own)]
                yield pa.RecordBatch.from_arrays([pa.array(own[marks > 0])], schema=schema)

    asked = messages.drop("repeated").join(replies, ["sender", "owner"])
    return asked.mapInArrow(read, "fingerprint long").distinct()


def _suspected(rows: DataFrame, suspects: DataFrame, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose fingerprint is a suspect's, with few others, and the rest.

    The filter is a bit per fingerprint, of bounded size. Where it lets a row
    through by chance, the row is compared in vain.
    """

    def bit(column: Column) -> Column:
        return F.pmod(column, F.lit(1 << filter_bits)) + 1

    own, bucket, bits = spare_names(rows, "bit", "bucket", "bits")
    place = bit(F.col("fingerprint"))
    bitmaps = suspects.groupBy(F.bitmap_bucket_number(place).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bits)
    )
    at = F.bitmap_bit_position(F.col(own))
    byte = F.conv(F.hex(F.substring(F.col(bits), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    tested = (
        rows.withColumn(own, place)
        .withColumn(bucket, F.bitmap_bucket_number(F.col(own)))
        .join(F.broadcast(bitmaps), bucket, "left")
    )
    return tested.filter(marked).select(rows.columns), tested.filter(~marked).select(rows.columns)


def exact_duplicates(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal if their bytes are after ``normalise``; a null text is
    empty. Of equal texts the row with the largest id stays: ``keep_id`` is its
    id and ``kept`` true for it alone. Rows equal in id and text are told apart
    by nothing, so one of them stays. Null ids are less than any other; a group
    of nothing else has a null ``keep_id``. No rows give none; other columns
    are not looked at.

    Fingerprints are as long as the number of rows asks for. A hot text is sent
    once by each task, and its copies are counted in each task before they are
    shuffled; the rows of a text are joined with its group by digest.
    """
    text = F.coalesce(normalise(F.col(text_col)), F.lit(""))
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    hashed = settle(texts.select("doc_id", "hash", F.sha2("text", 256).alias("text_sha256")), "hashed")
    count = hashed.count()
    bits = min(60, max(24, count.bit_length() + SPARE_BITS))
    owners = max(FEWEST_OWNERS, -(-count // OWNER_ROWS))

    def printed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("fingerprint", F.shiftrightunsigned("hash", 64 - bits)).drop("hash")

    rows, texts = printed(hashed), printed(texts)
    messages = settle(_messages(rows, owners, bits), "messages")
    replies = _replies(messages, owners, bits)
    suspects = settle(_suspects(messages, replies, owners, bits), "suspects")
    filter_bits = min(FILTER_BITS, max(16, (SUSPECT_BITS * suspects.count()).bit_length()))

    meant, _ = _suspected(texts, suspects, filter_bits)
    groups = settle(
        meant.groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"),
        "groups",
    )
    meant, alone = _suspected(rows, suspects, filter_bits)
    # Rows equal in id and text are one row with a number until they are told apart.
    counted = meant.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies"))
    among = counted.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        "text_sha256",
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    lone = alone.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    return among.withColumn("kept", stays).select(*names).unionByName(lone)
