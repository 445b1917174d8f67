"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, where ``docs`` is the whole output of the
stage before, read back from Parquet, and returns a DataFrame. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import keep, read_table
from tallyloom.llm.minhash_forest import near_duplicate_texts
from tallyloom.llm.packing import packed_pieces
from tallyloom.llm.quality_votes import good_documents
from tallyloom.llm.source_mix import mixed_documents
from tallyloom.llm.suffix_dedup import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled documents vote for."""
    return good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies.

    Documents without an id stay, as do rows that repeat a kept id.
    """
    found = near_duplicate_texts(docs, width=5, percent=80)
    return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur more than once."""
    return without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: one row per document and repetition."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1,024 tokens."""
    return packed_pieces(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("packing", packing),
]

# SQL has no tokenizer and no latent-semantic space.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = keep(stage(spark, docs, sf_dir), name)
    return docs
