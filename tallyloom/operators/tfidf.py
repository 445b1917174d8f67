"""TF-IDF in long form, and packed features for learners."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.naive_bayes import counted
from tallyloom.operators.ranking import ordered_index
from tallyloom.operators.skew import BROADCAST_BYTES, Size, lookup_join, measure
from tallyloom.session import materialize


@dataclass(frozen=True)
class Vocabulary:
    """``(token, df, idf)`` of the training documents and its measured size."""

    table: DataFrame
    size: Size


def fit_idf(docs: DataFrame, tokens: Column, documents: int) -> Vocabulary:
    """Smoothed inverse document frequency ``ln((1 + n) / (1 + df)) + 1``.

    Repeats are removed inside each row, so the document frequency is a plain
    count that is combined in each task before the shuffle.
    """
    df = docs.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    idf = F.ln(F.lit(1.0 + documents) / (F.col("df") + 1)) + 1
    table = materialize(df.select("token", "df", idf.alias("idf")), "vocabulary")
    return Vocabulary(table, measure(table, "token"))


def transform(
    counts: DataFrame, vocabulary: Vocabulary, row_id: str, extra: tuple[str, ...] = (), limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(row_id, *extra, token, w)``: weights scaled to unit length per document; unknown tokens drop out."""
    joined = lookup_join(counts, vocabulary.table, "token", row_id, "df", "inner", vocabulary.size, limit)
    weighted = joined.withColumn("w", F.col("m") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(row_id)))
    return weighted.select(row_id, *extra, "token", (F.col("w") / norm).alias("w"))


def numbered(vocabulary: Vocabulary) -> tuple[Vocabulary, int]:
    """The vocabulary with a place ``idx`` per token in the order of the tokens, and the number of places."""
    return Vocabulary(ordered_index(vocabulary.table, "token", out="idx"), vocabulary.size), vocabulary.size.rows


def narrowed(vocabulary: Vocabulary, tokens: DataFrame) -> Vocabulary:
    """The part of the vocabulary that occurs in ``tokens``; frequencies stay those of all documents."""
    table = materialize(vocabulary.table.join(tokens.select("token").distinct(), "token", "left_semi"), "vocabulary")
    return Vocabulary(table, measure(table, "token"))


def packed(tokens: DataFrame, vocabulary: Vocabulary, row_id: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document with arrays ``idx`` and ``val``; needs a numbered vocabulary.

    ``tokens`` are occurrences. With a broadcast vocabulary they are summed up
    per place before the first shuffle, otherwise counted per token before it.
    A list never outgrows the text of its own document.
    """
    tokens = tokens.select(row_id, "token")
    counts = tokens.withColumn("m", F.lit(1)) if vocabulary.size.fits(len(vocabulary.table.columns), limit) else counted(tokens)
    joined = lookup_join(counts, vocabulary.table, "token", row_id, "df", "inner", vocabulary.size, limit)
    per_place = joined.groupBy(row_id, "idx").agg(F.sum(F.col("m") * F.col("idf")).alias("w"))
    lists = per_place.groupBy(row_id).agg(
        F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("_p"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm")
    )
    return lists.select(
        row_id,
        F.transform("_p", lambda s: s["idx"].cast("int")).alias("idx"),
        F.transform("_p", lambda s: s["w"] / F.col("_norm")).alias("val"),
    )


def hashed_features(df: DataFrame, tokens: Column, train: Column, places: int) -> DataFrame:
    """Column ``features``: the same weighting as sparse vectors with a fixed number of hashed places.

    The vectors stay inside the JVM, for estimators whose statistics grow with
    the number of features.
    """
    terms = HashingTF(numFeatures=places, inputCol="_tokens", outputCol="_tf").transform(df.withColumn("_tokens", tokens))
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(terms.where(train)).idf.toArray() + 1.0
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(np.asarray(idf)), inputCol="_tf", outputCol="_scaled").transform(terms)
    return Normalizer(p=2.0, inputCol="_scaled", outputCol="features").transform(scaled).drop("_tokens", "_tf", "_scaled")
