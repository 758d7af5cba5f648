"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes the session, the documents the stage before kept, and the
folder of the tables; all but the last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm import jaccard, mix, packing, pii, quality
from quotewright.llm.common import forget, settle, table
from quotewright.llm.queries import tokenizer_path

LENGTH = "n_chars"


def _length(docs: DataFrame) -> str | None:
    return LENGTH if LENGTH in docs.columns else None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    labels = table(spark, sf_dir, "labels")
    # The ids of the labelled sample are bounded, so only their texts are measured to fit.
    labelled = docs.join(F.broadcast(quality.labelled_ids(labels).select("doc_id")), "doc_id", "left_semi")
    model = quality.fit_quality(quality.with_statistics(labelled), labels)
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind."""
    return pii.redact_pii(docs, pii.fit_pii(docs), length_col=_length(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, repeated or left out, in training order."""
    return mix.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]

# The forest, the trees and the packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; what a stage gives is written and read again."""
    docs, given = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if given is not None:
            forget(given)
        given = docs
    return STAGES[-1][1](spark, docs, sf_dir)
