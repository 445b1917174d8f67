"""K-means on array columns.

The model is a small matrix of centers, held by the driver and sent with the
code; vectors stay where they are. One iteration is one pass that returns a few
partial sums per batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.hashing import hash_number
from tallyloom.operators.sampling import first_shuffled

# Squared distances are rounded to this many digits before the nearest center
# is chosen, so that equal distances compare equal.
DIGITS = 9


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest center, the lowest on ties, and the squared distance.

    One product of matrices tells most points apart; those whose two nearest centers
    are closer than it can tell get all their distances as sums of squares.
    """
    best = np.zeros(len(points), np.int64)
    if len(centers) > 1 and len(points):
        norms, sizes = (centers * centers).sum(axis=1), (points * points).sum(axis=1)
        rough = norms - 2 * (points @ centers.T)
        best = rough.argmin(axis=1)
        two = np.partition(rough, 1, axis=1)
        close = np.flatnonzero(~(two[:, 1] - two[:, 0] > 1e-9 * (sizes + norms.max()) + 10.0 ** (1 - DIGITS)))
        if len(close):
            best[close] = np.stack([((points[close] - c) ** 2).sum(axis=1) for c in centers], axis=1).round(DIGITS).argmin(axis=1)
    return best, ((points - centers[best]) ** 2).sum(axis=1).round(DIGITS)


def assign(vector: str, centers: np.ndarray) -> Column:
    """Cluster of every vector."""

    @F.pandas_udf("int")
    def cluster(vectors: pd.Series) -> pd.Series:
        return pd.Series(nearest(matrix(vectors), centers)[0].astype("int32"))

    return cluster(F.col(vector))


def initial_centers(df: DataFrame, row_id: str, vector: str, k: int, seed: int) -> np.ndarray:
    """``k`` distinct rows in hash order."""
    rows = first_shuffled(df.select(row_id, vector), row_id, k, seed).collect()
    return np.array([r[vector] for r in rows], dtype=np.float64)


def spread_centers(df: DataFrame, row_id: str, vector: str, k: int, seeds: Sequence[int]) -> list[np.ndarray]:
    """For every seed ``k`` vectors, each drawn with a chance proportional to its squared distance from the earlier ones.

    A row's draw is an exponential number from a hash, divided by the squared
    distance; the smallest wins, ties by row id. A center takes one pass for all
    seeds, which returns one row. Fewer distinct vectors than ``k`` give fewer centers.
    """
    chosen: list[list[np.ndarray]] = [[] for _ in seeds]
    for step in range(k):
        held = [np.array(c) for c in chosen]

        @F.pandas_udf("array<double>")
        def gaps(vectors: pd.Series) -> pd.Series:
            points = matrix(vectors)
            found = [nearest(points, c)[1] if len(c) else np.ones(len(points)) for c in held]
            return pd.Series(list(np.stack(found, axis=1)))

        told = df.select(row_id, vector, gaps(vector).alias("_gaps"))
        firsts = []
        for i, seed in enumerate(seeds):
            gap = F.get("_gaps", F.lit(i))
            key = -F.log((hash_number(step, row_id, seed) + 1) / F.lit(2.0**60)) / gap
            firsts.append(F.min(F.when(gap > 0, F.struct(key.alias("key"), F.col(row_id).alias("row"), F.col(vector).alias("v")))).alias(f"r{i}"))
        for own, first in zip(chosen, told.agg(*firsts).first()):
            if first is not None:
                own.append(np.array(first.v, dtype=np.float64))
    return [np.array(c) for c in chosen]


@dataclass
class Run:
    """State of one Lloyd loop: ``used`` gave the latest assignment, ``centers`` are its means."""

    centers: np.ndarray
    used: np.ndarray | None = None
    cost: float = float("inf")
    steps: int = 0
    done: bool = False


def _points(column: pa.Array) -> np.ndarray:
    """Vectors of a batch; none of them may be missing."""
    if column.null_count:
        raise ValueError("a vector is missing")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _partial_sums(runs: Sequence[tuple[int, np.ndarray, np.ndarray | None]]):
    """Per task and run: size, changes, cost and vector sum of every cluster met, one after the other."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {run: np.zeros((len(c), 3 + c.shape[1])) for run, c, _ in runs}
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch.column(0))
            facts = np.column_stack([np.ones(len(points)), np.zeros((len(points), 2)), points])
            for run, centers, previous in runs:
                best, facts[:, 2] = nearest(points, centers)
                facts[:, 1] = best != nearest(points, previous)[0] if previous is not None else 1
                order = np.argsort(best, kind="stable")
                met, first = np.unique(best[order], return_index=True)
                tallies[run][met] += np.add.reduceat(facts[order], first, axis=0)
        for run, tally in tallies.items():
            met = np.flatnonzero(tally[:, 0])
            if len(met):
                columns = [pa.array(np.full(len(met), run), pa.int32()), pa.array(met, pa.int32()), pa.array(list(tally[met]))]
                yield pa.record_batch(columns, ["run", "c", "facts"])

    return task


PARTIAL = "run int, c int, facts array<double>"


# Tasks whose partial sums a pass sends to the driver as they are; those of more tasks are summed before.
DIRECT_TASKS = 256


def partial_sums(df: DataFrame, vector: str, runs: Sequence[tuple[int, np.ndarray, np.ndarray | None]]) -> DataFrame:
    """``(run, c, facts)`` of every task: size, changes, cost and vector sum in one array."""
    return df.select(vector).mapInArrow(_partial_sums(runs), PARTIAL)


def cluster_sums(df: DataFrame, vector: str, runs: Sequence[tuple[int, np.ndarray, np.ndarray | None]]) -> DataFrame:
    """``(run, c, n, moved, cost, sums)``: size, changes, cost and vector sum of every cluster."""
    facts = (
        partial_sums(df, vector, runs).select("run", "c", F.posexplode("facts").alias("pos", "v"))
        .groupBy("run", "c", "pos")
        .agg(F.sum("v").alias("v"))
        .groupBy("run", "c")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("facts"))
    )
    n, moved, cost = (F.get("facts", F.lit(i)) for i in range(3))
    return facts.select(
        "run", "c", n.cast("bigint").alias("n"), moved.cast("bigint").alias("moved"), cost.alias("cost"),
        F.slice("facts", F.lit(4), F.size("facts") - 3).alias("sums"),
    )


def lloyd(df: DataFrame, vector: str, starts: Sequence[np.ndarray], max_step: int) -> list[Run]:
    """Lloyd iterations from several starting points in common passes.

    A run ends when no vector changes its cluster or after ``max_step`` passes.
    Whether a vector changed is decided from the previous and the present
    centers, so no assignment table is kept between passes. A cluster that loses
    all its vectors keeps its center.
    """
    runs = [Run(np.array(s, dtype=np.float64)) for s in starts]
    direct = df.rdd.getNumPartitions() <= DIRECT_TASKS
    for step in range(max_step):
        active = [(i, r.centers, r.used) for i, r in enumerate(runs) if not r.done]
        if not active:
            break
        told = {i: np.zeros((len(c), 3 + c.shape[1])) for i, c, _ in active}
        if direct:
            for r in partial_sums(df, vector, active).collect():
                told[r.run][r.c] += r.facts
        else:
            for r in cluster_sums(df, vector, active).collect():
                told[r.run][r.c] = [r.n, r.moved, r.cost, *r.sums]
        for i, centers, _ in active:
            run, mine = runs[i], told[i]
            run.used, run.centers = centers, centers.copy()
            run.cost, run.steps = float(mine[:, 2].sum()), step + 1
            met = mine[:, 0] > 0
            run.centers[met] = mine[met, 3:] / mine[met, :1]
            run.done = not mine[:, 1].any()
    return runs


def contingency(df: DataFrame, cluster: str = "c", label: str = "label") -> DataFrame:
    return df.groupBy(cluster, label).agg(F.count("*").alias("n"))


def zero_filled(cells: DataFrame, k: int, cluster: str = "c", label: str = "label") -> DataFrame:
    """All ``k * k`` cells of cluster and label, absent ones with count zero."""
    numbers = F.sequence(F.lit(0), F.lit(k - 1))
    grid = cells.sparkSession.range(1).select(F.explode(numbers).alias(cluster))
    grid = grid.select(cluster, F.explode(numbers).alias(label))
    return grid.join(cells, [cluster, label], "left").select(cluster, label, F.coalesce("n", F.lit(0)).alias("n"))


def majority(cells: DataFrame, cluster: str = "c", label: str = "label") -> DataFrame:
    """Most frequent label of every cluster, the lowest label on ties."""
    return cells.groupBy(cluster).agg(F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias("mapped"))


def apply_mapping(df: DataFrame, mapping: DataFrame, cluster: str = "c") -> DataFrame:
    """Replace clusters by mapped labels; the mapping has one row per cluster."""
    return df.join(F.broadcast(mapping.withColumnRenamed("mapped", "pred")), cluster)


MODES = ("voting", "km")


def cluster_labels(cells: DataFrame, k: int, mode: str) -> DataFrame:
    """``(c, mapped)`` by majority vote or by optimal one-to-one matching."""
    from tallyloom.operators.matching import best_matching

    if mode == "voting":
        return majority(zero_filled(cells.where(F.col("label") < k), k))
    if mode == "km":
        return best_matching(zero_filled(cells.where(F.col("label") < k), k), k)
    raise ValueError(f"unknown mapping mode {mode!r}, expected one of {MODES}")
