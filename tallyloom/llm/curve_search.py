"""Nearest neighbours by inner product along shifted Hilbert curves."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import drop, keep
from tallyloom.llm.hilbert import hilbert_keys
from tallyloom.llm.ordering import positions

AXES, BITS = 4, 15
# Rows of a curve that one task holds as candidates.
BLOCK = 2_048
# Bound on the rows that place the grid, and on the queries that set the window.
GRID_SAMPLE, QUERY_SAMPLE = 4_096, 128


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of one query: largest score, then smallest id."""
    if len(ids) > k:
        edge = np.partition(scores, len(ids) - k)[len(ids) - k]
        inside = scores >= edge
        scores, ids = scores[inside], ids[inside]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class _Curves:
    """Several projections of one vector length onto curve positions."""

    def __init__(self, sample: np.ndarray, largest: float, curves: int, seed: int):
        self.largest = largest
        rng = np.random.default_rng([seed, sample.shape[1]])
        size = sample.shape[1] + 1
        axes = min(AXES, size)
        self.maps = [np.linalg.qr(rng.standard_normal((size, axes)))[0] for _ in range(curves)]
        self.shifts = [rng.uniform(0, 0.25, axes) for _ in range(curves)]
        lifted = self.lift(sample)
        self.steps = [np.sort(lifted @ m, axis=0) for m in self.maps]

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """One more coordinate gives all vectors the same norm, so that the
        largest inner product is the smallest distance."""
        rest = np.maximum(self.largest**2 - np.einsum("ij,ij->i", vectors, vectors), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def keys(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        if query:
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
            lifted = np.hstack([vectors / norms * self.largest, np.zeros((len(vectors), 1))])
        else:
            lifted = self.lift(vectors)
        out = np.empty((len(vectors), len(self.maps)), np.int64)
        for c, (turn, shift, steps) in enumerate(zip(self.maps, self.shifts, self.steps)):
            flat = lifted @ turn
            share = np.stack([np.searchsorted(steps[:, a], flat[:, a]) for a in range(flat.shape[1])], axis=1) / len(steps)
            cells = ((share * 0.75 + shift) * (1 << BITS)).astype(np.int64)
            out[:, c] = hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1), BITS)
        return out


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _keyed(frames: dict[int, _Curves]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys: list = [None] * len(batch)
            sizes, asks = batch["dim"].to_numpy(), batch["query"].to_numpy()
            for dim in np.unique(sizes):
                for ask in (False, True):
                    rows = np.flatnonzero((sizes == dim) & (asks == ask))
                    if len(rows):
                        for r, k in zip(rows, frames[dim].keys(_stack(batch["vec"].iloc[rows]), ask)):
                            keys[r] = k
            yield batch.assign(keys=keys)

    return run


def _ranked(asked: pd.DataFrame, held: pd.DataFrame, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    ids, vectors = held["id"].to_numpy(), _stack(held["vec"])
    questions = _stack(asked["vec"])
    for first in range(0, len(questions), 256):
        scores = questions[first : first + 256] @ vectors.T
        for q, query, row in zip(asked["id"].to_numpy()[first:], questions[first:], scores):
            best, _ = _top(np.where(ids == q, -np.inf, row), ids, k + 1)
            best = best[best != q][:k]
            at = np.flatnonzero(np.isin(ids, best))
            yield q, *_top(np.array([np.dot(vectors[i], query) for i in at]), ids[at], k)


def _block_search(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim in group["dim"].unique():
            part = group[group["dim"] == dim]
            held, asked = part[~part["query"]], part[part["query"]]
            if len(held) and len(asked):
                out += [{"q": q, "ids": i, "scores": s} for q, i, s in _ranked(asked, held, k) if len(i)]
        return pd.DataFrame(out, columns=["q", "ids", "scores"])

    return run


def _scan(asked: pd.DataFrame, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for dim, held in batch.groupby("dim"):
                same = asked[asked["dim"] == dim]
                if len(same):
                    out += [{"q": q, "ids": i, "scores": s} for q, i, s in _ranked(same, held, k) if len(i)]
            yield pd.DataFrame(out, columns=["q", "ids", "scores"])

    return run


PARTIAL = "q bigint, ids array<bigint>, scores array<double>"


def _merged(partial: DataFrame, k: int) -> DataFrame:
    pairs = partial.select("q", F.explode(F.arrays_zip("ids", "scores")).alias("p"))
    pairs = pairs.groupBy("q", F.col("p.ids").alias("vec")).agg(F.max("p.scores").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(vectors: DataFrame, row_id: str, vector: str) -> DataFrame:
    rows = vectors.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    return rows.where(sound).dropDuplicates(["id"]).withColumn("dim", F.size("vec"))


def exact_neighbours(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Neighbours of a few queries (a pandas-sized table) by a scan of all rows."""
    return _merged(vectors.mapInPandas(_scan(queries.toPandas(), k), PARTIAL), k)


def curve_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    row_id: str = "vec_id",
    vector: str = "embedding",
    curves: int = 12,
    coverage: float = 0.95,
    seed: int = 11,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: neighbours found for the rows where ``is_query`` holds.

    ``is_query`` is an expression over the column ``id``. Every row is placed on several shifted Hilbert curves
    over different projections; a range sort gives its place on each. A query is
    compared with all rows of the blocks around its own place, on all curves,
    and the candidates are ranked by their inner products in double precision.

    The width of the windows follows the data: up to 128 queries, the
    smallest hashes, are answered exactly by a scan, and the window is the
    distance along the nearest curve that takes in ``coverage`` of their
    neighbours. Data without clusters need windows that together take in about
    all rows; clustered data need few blocks. Up to 4,096 rows place the grid.

    Rows with a null id, or a vector that is null, empty, zero or holds null or
    non-finite values, take no part. Of rows that share an id one is used.
    Vectors of different length are never compared. Fewer candidates than ``k``
    are all returned; an empty table gives no rows. Ties go to the smaller id.
    """
    rows, _ = keep(_usable(vectors, row_id, vector).withColumn("query", F.coalesce(is_query, F.lit(False))), "vectors")
    sums = rows.groupBy("dim").agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("sq")).collect()
    if not sums:
        return rows.select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        ).limit(0)
    by_hash = F.xxhash64(F.lit(seed), "id")
    frames = {}
    for row in sums:
        part = rows.where(F.col("dim") == row.dim)
        sample = _stack(part.orderBy(by_hash, "id").limit(GRID_SAMPLE).select("vec").toPandas()["vec"])
        frames[row.dim] = _Curves(sample, math.sqrt(row.sq), curves, seed)
    # A query is also a row, and stands on the curve in its own right.
    records = rows.withColumn("query", F.lit(False)).union(rows.where("query"))
    keyed = records.mapInPandas(_keyed(frames), "id bigint, vec array<double>, dim int, query boolean, keys array<bigint>")
    spread = keyed.select("id", "dim", "query", "vec", F.posexplode("keys").alias("curve", "key"))
    placed, placed_path = positions(spread, "curve", "dim", "key", "id", "query")
    asked = rows.where("query").orderBy(by_hash, "id").limit(QUERY_SAMPLE).drop("query")
    truth = exact_neighbours(rows, asked, k).select("q", "vec")
    marks = placed.select("curve", "id", "query", "idx")
    gaps = (
        truth.join(marks.where("query").select(F.col("id").alias("q"), "curve", F.col("idx").alias("at")), "q")
        .join(marks.where("not query").select(F.col("id").alias("vec"), "curve", "idx"), ["vec", "curve"])
        .groupBy("q", "vec")
        .agg(F.min(F.abs(F.col("idx") - F.col("at"))).alias("gap"))
    )
    width = gaps.agg(F.expr(f"percentile(gap, {coverage})").alias("w")).first().w or 0
    reach = math.ceil(width / BLOCK)
    block = F.floor(F.col("idx") / BLOCK)
    blocks = placed.groupBy("curve").agg(F.min(block).alias("first"), F.max(block).alias("last"))
    held = placed.where("not query").withColumn("block", block)
    sent = (
        placed.where("query")
        .join(F.broadcast(blocks), "curve")  # one row per curve
        .withColumn("block", F.explode(F.sequence(F.greatest(block - reach, "first"), F.least(block + reach, "last"))))
    )
    columns = ["curve", "block", "id", "dim", "query", "vec"]
    groups = held.select(columns).union(sent.select(columns)).groupBy("curve", "block")
    found, _ = keep(_merged(groups.applyInPandas(_block_search(k), PARTIAL), k), "neighbours")
    drop(rows.sparkSession, placed_path)
    return found.select(
        F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("vec").alias("vec_id"), "score"
    )
