"""Array expressions on embeddings and probability vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardize(vector: Column, mean: float = 0.5, std: float = 1.0) -> Column:
    return F.transform(vector, lambda v: (v.cast("double") - F.lit(mean)) / F.lit(std))


def standardize_rows(rows: Column, mean: float = 0.5, std: float = 1.0) -> Column:
    """Standardized values of an array of rows, such as an image, as one flat vector."""
    return standardize(F.flatten(rows), mean, std)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def softmax(scores: Column) -> Column:
    """Probabilities of class scores; the largest score is shifted to zero.

    A missing score (a class that cannot be chosen) gets probability zero.
    """
    peak = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.coalesce(F.exp(s - peak), F.lit(0.0)))
    return F.transform(raised, lambda e: e / total(raised))


def expected_rating(probs: Column) -> Column:
    """Sum of class probability times rating, ratings counted from one."""
    return total(F.transform(probs, lambda p, i: p * (i + 1)))


def first_argmax(scores: Column) -> Column:
    """Zero-based index of the largest value, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def squared_norm(vector: Column) -> Column:
    return total(F.transform(vector, lambda v: v.cast("double") * v.cast("double")))
