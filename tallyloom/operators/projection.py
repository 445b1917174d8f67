"""Linear coordinates for display: the main axes of a table of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.clustering import matrix


def _outer_sums(vector: str):
    """Per task, the sum of the outer products of all vectors, each led by a 1, as numbered cells."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                points = np.column_stack([np.ones(len(frame)), matrix(frame[vector])])
                total = points.T @ points if total is None else total + points.T @ points
        if total is not None:
            yield pd.DataFrame({"cell": np.arange(total.size), "v": total.ravel()})

    return task


def moments(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and covariance (over n) of the vectors that are not null.

    Only sums over cells of a matrix as wide as a vector are shuffled and reach
    the driver. Without a vector the count is 0 and the others are empty.
    """
    known = df.where(F.col(vector).isNotNull()).select(vector)
    cells = known.mapInPandas(_outer_sums(vector), "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    width = int(len(cells) ** 0.5)
    if not width:
        return 0, np.zeros(0), np.zeros((0, 0))
    total = cells.sort_values("cell")["v"].to_numpy().reshape(width, width)
    n, mean = total[0, 0], total[0, 1:] / total[0, 0]
    return int(n), mean, total[1:, 1:] / n - np.outer(mean, mean)


def main_axes(covariance: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` unit directions of largest variance, largest first.

    A direction has its largest component, the first of equal ones, positive.
    """
    _, axes = np.linalg.eigh(covariance)
    axes = axes.T[::-1][:k]
    lead = np.abs(axes).round(9).argmax(axis=1)
    return axes * np.sign(axes[np.arange(len(axes)), lead])[:, None]


def coordinate(vector: Column, mean: np.ndarray, axis: np.ndarray) -> Column:
    """Place of a vector along an axis through the mean."""
    along = F.aggregate(
        F.zip_with(vector, F.lit([float(a) for a in axis]), lambda v, a: v.cast("double") * a), F.lit(0.0), lambda s, v: s + v
    )
    return along - F.lit(float(mean @ axis))
