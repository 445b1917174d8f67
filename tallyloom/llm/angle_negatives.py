"""Hard negatives by triangle bounds on angles to reference directions.

Every row stores its angles to a few reference directions. The angle between two
rows lies between the largest difference and the smallest sum of their angles to
one reference, so their product lies between two cosines times their norms. Rows
whose interval misses what an anchor still looks for are never scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import drop, keep
from tallyloom.llm.ordering import positions

# Reference directions, and rows they are chosen from at most.
REFERENCES, SAMPLE = 16, 4_096
# Rows of a block, and anchors of a chunk.
BLOCK = 4_096
# Blocks whose ranges are compared with those of a chunk in one task.
DEAL = 64
SCALE = 256
# Largest error of an angle stored in single precision, with room; an arc cosine near 1 is good to half the digits.
ANGLE_ERROR = 1e-6
# Products of whole numbers below this are exact in double precision.
EXACT = 1 << 53


def quantized(vectors: DataFrame, is_anchor: Column, row_id: str, vector: str, label: Column) -> DataFrame:
    """``(id, label, dim, q, anchor)`` of the rows that take part; ``q`` holds ``floor(256 * x)``.

    So that every product fits 64 bits, components are held within
    ``2 ** 31 / sqrt(dim)``, which only values in the millions ever reach.
    """
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(row_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("x"), is_anchor.alias("anchor"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & sound).withColumn("dim", F.size("x"))
    most = F.floor(F.lit(2.0**31 - 1) / F.sqrt(F.greatest("dim", F.lit(1)))).cast("double")
    q = F.transform("x", lambda v: F.floor(F.greatest(F.least(v * SCALE, most), -most)).cast("int"))
    return rows.select("id", "label", "dim", q.alias("q"), F.coalesce("anchor", F.lit(False)).alias("anchor"))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v) for v in column])


def _directions(sample: np.ndarray, seed: int) -> np.ndarray:
    """Unit directions: first far from each other, then moved to the middle of the rows nearest to them."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen = [int(np.random.default_rng(seed).integers(len(unit)))]
    near = unit @ unit[chosen[0]]
    while len(chosen) < min(REFERENCES, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    middle = unit[chosen]
    for _ in range(8):
        best = (unit @ middle.T).argmax(axis=1)
        for r in range(len(middle)):
            mean = unit[best == r].sum(axis=0)
            if np.linalg.norm(mean) > 0:
                middle[r] = mean / np.linalg.norm(mean)
    return middle


def _angled(frames: dict[int, np.ndarray]):
    """Adds norm, angles and the nearest reference; a zero row stands at a right angle to everything."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            norms, angles, cells = np.zeros(len(batch)), [None] * len(batch), np.zeros(len(batch), np.int32)
            near = np.zeros(len(batch))
            for dim, rows in batch.groupby("dim").indices.items():
                q = _stack(batch["q"].iloc[rows]).astype(np.float64)
                norm = np.sqrt((q * q).sum(axis=1))
                turns = np.divide(q @ frames[dim].T, norm[:, None], out=np.zeros((len(q), len(frames[dim]))), where=norm[:, None] > 0)
                found = np.arccos(np.clip(turns, -1, 1))
                norms[rows] = norm
                if found.shape[1]:
                    cells[rows], near[rows] = found.argmin(axis=1), found.min(axis=1)
                for r, a in zip(rows, found):
                    angles[r] = a
            yield batch.assign(norm=norms, angles=angles, cell=cells, near=near)

    return run


@dataclass
class _Rows:
    """Rows of one block, or anchors of one chunk, all of one vector length."""

    idx: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    q: np.ndarray
    norm: np.ndarray
    angles: np.ndarray
    named: np.ndarray

    @classmethod
    def of(cls, frame: pd.DataFrame) -> _Rows:
        whole = [frame[c].to_numpy(np.int64) for c in ("idx", "id", "label")]
        return cls(
            *whole, _stack(frame["q"]).astype(np.int64), frame["norm"].to_numpy(), _stack(frame["angles"]).astype(np.float64),
            frame["named"].to_numpy(bool),
        )

    def told(self, at: np.ndarray, scores: np.ndarray, **more) -> pd.DataFrame:
        return pd.DataFrame(more | {"score": scores, "id": self.ids[at], "named": self.named[at], "idx": self.idx[at]})

    def bounds(self, norm: float, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest score that rows can have with an anchor."""
        scale = self.norm * norm
        if not self.angles.shape[1]:
            return -scale - 1, scale + 1
        least = np.maximum(np.abs(self.angles - angles).max(axis=1) - ANGLE_ERROR, 0)
        both = self.angles + angles
        most = np.minimum(np.minimum(both, 2 * np.pi - both).min(axis=1) + ANGLE_ERROR, np.pi)
        slack = scale * 1e-9 + 1
        return scale * np.cos(most) - slack, scale * np.cos(least) + slack

    def scores(self, inside: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whole-number products, in floating point only where that is exact."""
        rows = self.q[inside]
        if int(np.abs(q).max(initial=0)) * int(np.abs(rows).max(initial=0)) * len(q) < EXACT:
            return (rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        return (rows * q).sum(axis=1)


# Row ids in tasks: a null one is the largest number there is, and not ``named``.
LIKED = "anchor bigint, score bigint, id bigint, named boolean, idx bigint"
BETWEEN = "anchor bigint, positive bigint, score bigint, id bigint, named boolean, idx bigint"
LAST = (1 << 63) - 1


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, _Rows, _Rows] | None:
    """The anchors of a group as told, the anchors, and the block's rows; None if one side is missing."""
    asked, held = group[group["asks"]].reset_index(drop=True), group[~group["asks"]]
    return (asked, _Rows.of(asked), _Rows.of(held)) if len(asked) and len(held) else None


def _like(k: int):
    """The ``k`` best rows of an anchor's own label within a block; skips rows that cannot reach its floor."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out, sides = [], _sides(group)
        if sides:
            asked, a, rows = sides
            for i in np.flatnonzero((asked["own"] != asked["block"]) | asked["floor"].isna()):
                _, high = rows.bounds(a.norm[i], a.angles[i])
                inside = np.flatnonzero((rows.label == a.label[i]) & (rows.idx != a.idx[i]) & (high >= asked["floor"].fillna(-np.inf)[i]))
                scores = rows.scores(inside, a.q[i])
                best = np.lexsort((rows.idx[inside], rows.ids[inside], -scores))[:k]
                at = inside[best]
                out.append(rows.told(at, scores[best], anchor=a.idx[i]))
        return pd.concat(out) if out else pd.DataFrame(columns=["anchor", "score", "id", "named", "idx"])

    return run


def _between(k: int):
    """For each positive of an anchor, the ``k`` best rows of other labels inside its window."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out, sides = [], _sides(group)
        if sides:
            asked, a, rows = sides
            for i, windows in enumerate(asked["windows"]):
                low, high = rows.bounds(a.norm[i], a.angles[i])
                may = np.zeros(len(low), bool)
                for w in windows:
                    may |= (high >= w["low"]) & (low <= w["high"])
                inside = np.flatnonzero(may & (rows.label != a.label[i]))
                scores = rows.scores(inside, a.q[i])
                for w in windows:
                    fit = np.flatnonzero((scores >= w["low"]) & (scores <= w["high"]))
                    best = fit[np.lexsort((rows.idx[inside[fit]], rows.ids[inside[fit]], -scores[fit]))[:k]]
                    at = inside[best]
                    out.append(rows.told(at, scores[best], anchor=a.idx[i], positive=w["positive"]))
        return pd.concat(out) if out else pd.DataFrame(columns=["anchor", "positive", "score", "id", "named", "idx"])

    return run


def _ranges(rows: DataFrame, part: str, *more: Column) -> DataFrame:
    """Largest norm, labels and range of angles to each reference of the rows of each part."""
    ends = rows.groupBy(part, "dim").agg(F.max("norm").alias("norm"), F.min("label").alias("first"), F.max("label").alias("last"), *more)
    sides = rows.select(part, "dim", F.posexplode("angles").alias("r", "angle")).groupBy(part, "dim", "r")
    sides = sides.agg(F.min("angle").alias("low"), F.max("angle").alias("high")).groupBy(part, "dim")
    return ends.join(sides.agg(F.array_sort(F.collect_list(F.struct("r", "low", "high"))).alias("sides")), [part, "dim"], "left")


def _meetings(blocks: DataFrame, chunks: DataFrame, wanted: Column) -> DataFrame:
    """``(block, dim, chunk)`` wherever some row of a block and some anchor of a chunk may score the chunk's floor.

    Only ranges meet here, one row a block and one a chunk, each deal of blocks with every chunk.
    """
    deals = 1 + blocks.count() // DEAL
    held = blocks.withColumn("deal", F.col("block") % deals).alias("b")
    asked = chunks.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(deals - 1).cast("bigint")))).alias("c")
    pairs = held.join(asked, ["dim", "deal"]).where(wanted)
    gap = F.zip_with("b.sides", "c.sides", lambda b, c: F.greatest(b["low"] - c["high"], c["low"] - b["high"]))
    nearest = F.greatest(F.array_max(gap) - ANGLE_ERROR, F.lit(0.0))
    scale = F.col("b.norm") * F.col("c.norm")
    # A negative cosine is least negative with the smallest norms, which may be 0.
    highest = F.greatest(scale * F.cos(F.coalesce(nearest, F.lit(0.0))), F.lit(0.0)) + scale * 1e-9 + 1
    return pairs.where(F.col("floor").isNull() | (highest >= F.col("floor"))).select("block", "dim", "chunk")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    row_id: str = "vec_id",
    vector: str = "embedding",
    seed: int = 12,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` and ``label`` are expressions over ``vectors``. A score is the inner product of
    vectors rounded down to 1/256. An anchor's positives are its best
    ``positives`` other rows of its label; for each of them the best ``negatives`` rows of
    other labels are listed whose score lies between ``least`` percent of the
    positive's and all of it. Higher scores come first, ties by the smaller id.

    Rows are sorted by label, nearest reference and angle to it, and cut into blocks of
    4,096. First every block answers its own anchors; what they found is the floor under which no
    other row of their label matters. Then anchors go, 4,096 at a time, to the blocks of which some row may reach a
    floor, and at last to those of which some row may fall into a window. A
    task holds one block and one chunk of anchors; the references are chosen from at most
    4,096 rows, which changes the work but never the result. Where angles tell
    nothing, as among random directions, every anchor meets every row of its length.

    Rows with a null label or vector, or a null or non-finite component, take no part.
    Zero vectors score 0. A null id comes last among ties; rows that repeat an id are rows of their own, in a
    fixed order. Vectors of different length are never compared. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows, rows_path = keep(quantized(vectors, is_anchor, row_id, vector, label), "quantized")
    by_hash = F.xxhash64(F.lit(seed), "id", "q")
    frames = {}
    for dim in sorted(r.dim for r in rows.select("dim").distinct().collect()):
        sample = rows.where(F.col("dim") == dim).orderBy(by_hash, "id", "label").limit(SAMPLE).select("q").toPandas()["q"]
        frames[dim] = _directions(_stack(sample).astype(np.float64), seed)
    schema = "id bigint, label bigint, dim int, q array<int>, anchor boolean, norm double, angles array<float>, cell int, near double"
    # Vector and anchor mark only order rows that share an id.
    placed, placed_path = positions(rows.mapInPandas(_angled(frames), schema), "dim", "label", "cell", "near", "id", "q", "anchor")
    columns = ["idx", "id", "named", "label", "dim", "q", "norm", "angles"]
    placed = placed.withColumn("named", F.col("id").isNotNull()).withColumn("id", F.coalesce("id", F.lit(LAST)))
    placed = placed.withColumn("block", F.floor(F.col("idx") / BLOCK))
    chosen = placed.where("anchor").select(*columns, F.col("block").alias("own")).withColumnRenamed("idx", "at")
    ask, ask_path = positions(chosen, "at")
    ask = ask.withColumn("chunk", F.floor(F.col("idx") / BLOCK)).drop("idx").withColumnRenamed("at", "idx")

    def searched(held: DataFrame, sent: DataFrame, extra: str, search, schema: str) -> DataFrame:
        nothing = [F.lit(None).cast(sent.schema[c].dataType).alias(c) for c in ("own", extra)]
        both = held.select("block", "chunk", *columns, *nothing, F.lit(False).alias("asks")).union(
            sent.select("block", "chunk", *columns, "own", extra, F.lit(True).alias("asks"))
        )
        return both.groupBy("block", "chunk", "dim").applyInPandas(search, schema)

    def met(meetings: DataFrame, asked: DataFrame, extra: str, search, schema: str) -> DataFrame:
        """Search each block with the chunks of anchors it meets."""
        return searched(
            placed.join(meetings, ["block", "dim"]), asked.join(meetings, ["chunk", "dim"]), extra, search, schema
        )

    # Each block for its own anchors.
    alone = ask.withColumn("block", F.col("own")).withColumn("floor", F.lit(None).cast("double")).withColumn("chunk", F.lit(0))
    busy = placed.join(alone.select("block", "dim").distinct(), ["block", "dim"], "left_semi").withColumn("chunk", F.lit(0))
    near, near_path = keep(searched(busy, alone, "floor", _like(positives), LIKED), "near")
    floors = near.groupBy(F.col("anchor").alias("idx")).agg(F.when(F.count("*") >= positives, F.min("score")).cast("double").alias("floor"))
    blocks, blocks_path = keep(_ranges(placed, "block"), "blocks")

    # Other blocks of the label that may hold a row above the floor.
    seeking, seeking_path = keep(ask.join(floors, "idx", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), "floors")
    same = (F.col("b.first") <= F.col("c.last")) & (F.col("c.first") <= F.col("b.last"))
    meetings = _meetings(blocks, _ranges(seeking, "chunk", F.min("floor").alias("floor")), same)
    further = met(meetings, seeking, "floor", _like(positives), LIKED)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "idx")
    ranked = near.union(further).withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    liked, liked_path = keep(ranked.drop("place"), "positives")

    # Windows, and the blocks that may hold a row inside one of them. A negative score has an empty window.
    lowest = F.ceil(F.col("score").cast("decimal(20,0)") * least / 100).cast("bigint")
    window = F.struct(F.col("idx").alias("positive"), lowest.alias("low"), F.col("score").alias("high"))
    windows = liked.where("score >= 0").groupBy(F.col("anchor").alias("idx")).agg(F.collect_list(window).alias("windows"))
    floor = F.array_min(F.transform("windows", lambda w: w["low"])).cast("double")
    asking, asking_path = keep(ask.join(windows, "idx").withColumn("floor", floor), "windows")
    other = (F.col("b.first") != F.col("b.last")) | (F.col("c.first") != F.col("c.last")) | (F.col("b.first") != F.col("c.first"))
    meetings = _meetings(blocks, _ranges(asking, "chunk", F.min("floor").alias("floor")), other)
    pool = met(meetings, asking, "windows", _between(negatives), BETWEEN)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id", "idx")
    ranked = pool.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    name = F.when(F.col("named"), F.col("id"))
    names = ask.select(F.col("idx").alias("anchor"), name.alias("anchor_id"))
    told = liked.select("anchor", F.col("idx").alias("positive"), name.alias("positive_id"), F.col("score").alias("positive_score"))
    out, _ = keep(
        ranked.select("anchor", "positive", "rank", name.alias("negative_id"), F.col("score").alias("negative_score"))
        .join(told, ["anchor", "positive"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"),
        "hard-negatives",
    )
    drop(spark, rows_path, placed_path, ask_path, near_path, blocks_path, seeking_path, liked_path, asking_path)
    return out
