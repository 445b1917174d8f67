"""Views that present the given tables as mail, reviews and labelled vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tables with long text, and the unique key they can be dealt out by.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.

    A text table stored in fewer splits than there are cores is dealt out by its
    key, since tokenizing costs far more than moving so little. A table with
    enough splits is read as it is.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in TEXT_TABLES and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, TEXT_TABLES[name])
    return df


def mail(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """``(doc_id, label, sender, body)`` with label ``ham`` or ``spam``; on request also the mail without a label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "inner" if labelled else "left").select(
        "doc_id",
        F.when(F.col("quality") == 1, "ham").when(F.col("quality").isNotNull(), "spam").alias("label"),
        F.concat(F.lit("user"), F.col("doc_id").cast("string"), F.lit("@"), F.col("source"), F.lit(".example>")).alias("sender"),
        F.col("text").alias("body"),
    )


def reviews(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """``(doc_id, review, summary, overall)``; ``overall`` is text, as in the review file.

    On request also the reviews that nobody rated, with a null ``overall``.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels")
    overall = 1 + 2 * F.col("quality") + (1 - F.col("toxic")) + F.col("n_chars") % 2
    return docs.join(labels, "doc_id", "inner" if labelled else "left").select(
        "doc_id",
        F.col("text").alias("review"),
        F.substring_index("text", "\n", 1).alias("summary"),
        overall.cast("string").alias("overall"),
        "n_chars",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
