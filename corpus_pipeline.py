"""The corpus pipeline: raw documents to packed sequences, one operator a stage.

Defined cases, for every stage: a null text counts as empty; of rows with equal texts one
stays, of the largest doc_id, null below any; of near copies the one of the smallest, null
after all; a document of null doc_id is a document like any other, and repeated ids are
told apart by their place in the table; texts of any length are read whole; other columns
stay as they are, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernstone.llm import exact, packing, quality, simhash, suffix
from quernstone.llm.common import Chain
from quernstone.llm.tokens import tokenizer_path
from quernstone.session import load


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.drop_rejected(docs, load(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return simhash.drop_near_copies(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has already go from the text."""
    return suffix.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their place in a sequence."""
    return packing.packed_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("suffix-array dedup", repeat_removal),
    ("best-fit packing", pack),
]
#: The classifier and the fingerprints cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; a stage's table goes when its successor is written."""
    chain = Chain(spark)
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = chain.written(docs, f"stage-{k}")
    chain.close()  # the pieces of the last stage are a table of their own
    return docs
