"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdcflow.llm.common import documents, stored
from cdcflow.llm.decontamination import benchmark, keep_unseen
from cdcflow.llm.jaccard import keep_one
from cdcflow.llm.packing import pack_documents
from cdcflow.llm.pii import replaced_documents
from cdcflow.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest doc_id, of each group of linked ones."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return keep_unseen(docs, benchmark(spark, sf_dir))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data in their texts."""
    return replaced_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences.

    Executors still hold what earlier stages took, so workers encode less at once, remember fewer pieces, and keep none of
    them from task to task.
    """
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1_000_000, 100_000, keep=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("packing", packing),
]
# The stages run tokenizers, edit distances and fitted weights, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
