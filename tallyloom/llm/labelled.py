"""Bounded samples of labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(row_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, seed: int
) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, text, y)`` for up to ``per_class`` rows of each class, and the classes' full counts.

    The rows with the smallest hashes of their ids are taken, so their ids, at most
    ``2 * per_class`` of them, can be sent to every task of the scan of
    ``documents``. Labels other than 0 and 1 are ignored; a document labelled
    twice counts with its smaller label.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(usable & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64(F.lit(seed), "doc_id"), "doc_id"]
    parts = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = reduce(DataFrame.union, parts)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), counts
