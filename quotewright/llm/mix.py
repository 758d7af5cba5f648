"""Mixing sources to target weights along a curriculum, in DataFrame operations only.

Each source has a weight schedule over training time, here a line from a start
to an end weight. Its integral says which part of the source's words is due by
a time; the inverse of that gives the words of a document their time, and
documents are range-sorted by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import row_key, settle, spare_names, word_count

# Weights by rank of the source, and the most passes over a source.
WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
# Hex digits of the hash that deal a source's documents into buckets.
BUCKET_DIGITS = 3


def source_targets(totals: DataFrame) -> DataFrame:
    """``target`` per source from (source, source_size).

    Sources in code point order, null last, weigh ``WEIGHTS`` in turn. A source
    stops at its cap; what it leaves is shared by weight among the rest. Taken
    by cap per weight, a source is full if its share of what the earlier ones
    left reaches its cap. There is a row per source, however many documents.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(ranked) - 1) % len(WEIGHTS) + 1
    )

    def left(name: str) -> Column:
        return F.sum(name).over(everything) - F.coalesce(F.sum(name).over(earlier), F.lit(0))

    return (
        totals.withColumn("weight", weight.cast("long"))
        .withColumn("cap", MOST_PASSES * F.col("source_size"))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("words_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        .withColumn("weight_left", left("weight"))
        .withColumn("level", F.col("words_left") / F.col("weight_left"))
        .withColumn("full", F.col("room") <= F.col("level"))
        .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level")),
        )
        .select("source", "source_size", "weight", "target")
    )


def due_time(share: Column, start: Column, end: Column) -> Column:
    """When a share of a source's words is due if its weight goes from start to end.

    The integral of the line up to t is start·t + (end − start)·t²/2; the
    positive root of its equation with share·(start + end)/2.
    """
    slope = end - start
    root = (F.sqrt(start * start + slope * (start + end) * share) - start) / slope
    return F.when(slope == 0, share).otherwise(root)


def mixed_rows(documents: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """The rows of ``mix_sources`` before they are sorted."""
    sized = settle(
        documents.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    quota = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0)
    targets = (
        source_targets(totals)
        .withColumn("quota", quota)
        .withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
        .withColumn("source_key", row_key("source"))
        .drop("source")
    )
    counted = (
        sized.groupBy("source", "doc_id", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("source_key", row_key("source"))
        .withColumn("order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    ahead = (Window.unboundedPreceding, -1)
    by_bucket = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(*ahead)
    buckets = (
        sized.select(
            row_key("source").alias("source_key"),
            F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, BUCKET_DIGITS).alias("bucket"),
            "size",
        )
        .groupBy("source_key", "bucket")
        .agg(F.sum("size").alias("bucket_words"))
        .withColumn("bucket_before", F.coalesce(F.sum("bucket_words").over(by_bucket), F.lit(0)))
        .drop("bucket_words")
        .join(targets, "source_key")
    )
    inside = Window.partitionBy("source_key", "bucket").orderBy("order", "doc_id", "size").rowsBetween(*ahead)
    placed = (
        counted.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .join(buckets, ["source_key", "bucket"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("before", F.col("bucket_before") + F.col("inside") + F.col("copy") * F.col("size"))
    )
    room = F.col("rest") - F.col("before")
    last = F.when((room > 0) & (2 * room >= F.col("size")), F.col("size")).otherwise(0)
    share = F.col("before") / F.col("quota")
    result = placed.withColumn("taken", F.col("passes") * F.col("size") + last).withColumn(
        "position",
        F.when(F.col("taken") > 0, due_time(share, F.lit(1.0), F.col("weight").cast("double"))),
    )
    return result.select(
        "doc_id", "copy", "size", "source", "source_size", "target", "taken",
        "before", "passes", "rest", "quota", "weight", "position",
    )


def mix_sources(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """What the mix takes of each document, sorted by its first training position.

    Returns doc_id, copy, size, source, source_size, target, taken, before (the
    source's words ahead of it), passes (whole passes over the source), rest
    (words of the pass after them), position (0 to 1; null if nothing is taken).

    Documents of a source stand in the order of the MD5 of their id. Whole
    passes take each document whole; the last one ends before or after the
    document it would stop in, whichever is nearer the target, so a source
    gives its target but for half a document. Null text has no words; a null source is a source of its own; null ids share
    one place in the order and follow by size. Rows equal in id, source and
    size are counted first and numbered by ``copy``. Nothing to mix gives
    targets of 0. Other columns are not looked at.

    A source is dealt into buckets by hash: sums go over buckets first, then
    within each, so no task holds a source.
    """
    mixed = mixed_rows(documents, id_col, source_col, text_col)
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id", "copy")


def placements(mixed: DataFrame) -> DataFrame:
    """A row per document and pass that takes words of it.

    Adds pass_no, words (taken in that pass) and the position of their first word.
    """
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))
    words = F.when(F.col("pass_no") < F.col("passes"), F.col("size")).otherwise(
        F.col("taken") - F.col("passes") * F.col("size")
    )
    share = (F.col("pass_no") * F.col("source_size") + F.col("before")) / F.col("quota")
    return (
        mixed.filter(F.col("taken") > 0)
        .withColumn("pass_no", number)
        .withColumn("words", words)
        .filter(F.col("words") > 0)
        .withColumn("position", due_time(share, F.lit(1.0), F.col("weight").cast("double")))
    )


def mixed_documents(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The documents of the mix with their own columns, range-sorted by training position.

    A document stands there once for each pass that takes it, and not at all
    if none does. Texts are whole, as they came. Rows equal in id, source and
    size are told apart by the hash of all their columns; they are numbered
    without their texts, which are shuffled twice: to their places, and in order.
    """
    key, row, copies, start, copy, pass_no, position = spare_names(
        documents, "key", "row", "copies", "start", "copy", "pass_no", "position"
    )
    size = word_count(F.col(text_col))
    keyed = documents.withColumns({row: F.xxhash64(*documents.columns), copy: size})
    keyed = keyed.withColumn(key, row_key(id_col, source_col, copy)).drop(copy)
    ahead = Window.partitionBy(key).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    found = settle(keyed.groupBy(key, row).agg(F.count("*").alias(copies)), "mix-rows")
    numbered = found.withColumn(start, F.coalesce(F.sum(copies).over(ahead), F.lit(0)))
    placed = placements(mixed_rows(documents, id_col, source_col, text_col)).select(
        row_key("doc_id", "source", "size").alias(key),
        F.col("copy").alias(copy),
        F.col("pass_no").alias(pass_no),
        F.col("position").alias(position),
    )
    own = (F.col(copy) >= F.col(start)) & (F.col(copy) < F.col(start) + F.col(copies))
    placed = placed.join(numbered, key).filter(own).select(key, row, pass_no, position)
    if not found.filter(F.col(copies) > 1).isEmpty():
        # Rows equal in all columns: one of them stands for the places of all.
        keyed = keyed.dropDuplicates([key, row])
    return keyed.join(placed, [key, row]).orderBy(position, key, pass_no).select(documents.columns)
