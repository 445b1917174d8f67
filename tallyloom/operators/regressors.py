"""Base regressors for ensembles.

A learner fits several models at once from ``draws (model_id, row_id,
multiplicity)``: the training rows are read in common passes and weighted by how
often each model drew them. A fitted model adds a prediction column. An
iterative learner may start from the model ``near``; its objective has a single
minimum, so this saves passes only.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyloom.operators.softmax import CONSTANT, margins, with_constant
from tallyloom.session import materialize


@dataclass(frozen=True)
class LineModel:
    slope: float
    intercept: float

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, F.lit(self.slope) * F.col("x") + F.lit(self.intercept))


@dataclass(frozen=True)
class LineLearner:
    """Least squares on one feature ``x``: all models are one aggregate over weighted moments."""

    def fit(self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int, near=None) -> list[LineModel]:
        m, x, y = F.col("multiplicity").cast("double"), F.col("x"), F.col(label)
        moments = (
            train.select(row_id, "x", label)
            .join(draws, row_id)
            .groupBy("model_id")
            .agg(F.sum(m).alias("n"), F.sum(m * x).alias("sx"), F.sum(m * y).alias("sy"),
                 F.sum(m * x * y).alias("sxy"), F.sum(m * x * x).alias("sxx"))
            .collect()
        )
        fitted = {}
        for r in moments:
            spread = r.n * r.sxx - r.sx * r.sx
            slope = (r.n * r.sxy - r.sx * r.sy) / spread if spread else 0.0
            fitted[r.model_id] = LineModel(slope, (r.sy - slope * r.sx) / r.n)
        return [fitted[i] for i in range(models)]


def _flat(idx: pd.Series, val: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells per row, and places and values of all rows of a batch one after the other; null is no cells."""
    rows = [np.asarray(i if i is not None else [], dtype=np.int32) for i in idx]
    vals = [np.asarray(v if v is not None else [], dtype=np.float64) for v in val]
    counts = np.array([len(r) for r in rows], dtype=np.int64)
    if not rows:
        return counts, np.zeros(0, np.int32), np.zeros(0)
    return counts, np.concatenate(rows), np.concatenate(vals)


# Steps a weight in (0, 1] is rounded up to for the cuts of a tree; 0 means that the token is missing.
BINS = 64
# Nodes of one level that are sent to all tasks (about 10 MB); more are joined by shuffle.
LEVEL_NODES = 1 << 18


@dataclass(frozen=True)
class TreeModel:
    """A regression tree: node 1 is the root, nodes ``2n`` and ``2n + 1`` stand below node ``n``.

    A row goes to ``2n + 1`` where its step at ``place`` exceeds ``cut``; ``place`` is -1 at a leaf.
    The arrays are sorted by ``node``. A tree of depth d has fewer than ``2 ** (d + 1)`` nodes.
    """

    node: np.ndarray
    place: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return int(self.node.max()).bit_length() - 1

    def walk(self, counts: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        """Values of the leaves that the rows of a batch reach, all rows one level at a time."""
        width = int(max(idx.max(initial=0), self.place.max())) + 1
        keys = np.repeat(np.arange(len(counts), dtype=np.int64), counts) * width + idx
        order = np.argsort(keys)
        keys, steps = keys[order], np.clip(np.ceil(np.round(val[order] * BINS, 6)), 1, BINS)
        at = np.zeros(len(counts), np.int64)
        going = np.arange(len(counts))
        while len(going):
            going = going[self.place[at[going]] >= 0]
            here = at[going]
            wanted = going * width + self.place[here]
            met = np.searchsorted(keys, wanted)
            step = np.zeros(len(going))
            inside = met < len(keys)
            inside[inside] = keys[met[inside]] == wanted[inside]
            step[inside] = steps[met[inside]]
            at[going] = np.searchsorted(self.node, 2 * self.node[here] + (step > self.cut[here]))
        return self.value[at]

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def leaf(idx: pd.Series, val: pd.Series) -> pd.Series:
            return pd.Series(shared.value.walk(*_flat(idx, val)))

        return df.withColumn(out, leaf("idx", "val"))


def _reached(tree: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray, keys: np.ndarray, steps: np.ndarray, width: int) -> np.ndarray:
    """Nodes that rows reach below the cuts ``(node, place, cut)`` found so far; ``keys`` are row * width + place, in order."""
    node, (known, place, cut) = np.ones(len(rows), np.int64), tree
    going = np.arange(len(rows) if len(known) else 0)
    while len(going):
        at = np.minimum(np.searchsorted(known, node[going]), len(known) - 1)
        met = known[at] == node[going]
        going, at = going[met], at[met]
        wanted = rows[going] * width + place[at]
        held = np.searchsorted(keys, wanted)
        inside = held < len(keys)
        inside[inside] = keys[held[inside]] == wanted[inside]
        step = np.zeros(len(going), np.int64)
        step[inside] = steps[held[inside]]
        node[going] = 2 * node[going] + (step > cut[at])
    return node


def _standing(batch: pa.RecordBatch, trees: list) -> Iterator[tuple]:
    """For each model its number, the nodes of the rows it drew, their numbers, weights and labels, and cells as ``(idx, steps, ends)``."""
    counts = batch.column("idx").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    idx = batch.column("idx").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    steps = batch.column("steps").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
    drawn = batch.column("drawn").flatten()
    owner = np.repeat(np.arange(len(batch)), batch.column("drawn").value_lengths().to_numpy(zero_copy_only=False))
    model, m = (drawn.field(f).to_numpy(zero_copy_only=False) for f in ("model_id", "m"))
    width = int(max(idx.max(initial=0), *(t[1].max(initial=0) for t in trees))) + 1
    keys = np.repeat(np.arange(len(counts)), counts) * width + idx
    order = np.argsort(keys, kind="stable")
    idx, steps, ends = idx[order], steps[order], np.concatenate([[0], np.cumsum(counts)])
    for i, tree in enumerate(trees):
        own = np.flatnonzero(model == i)
        rows = owner[own]
        yield i, _reached(tree, rows, keys[order], steps, width), rows, m[own], y[rows], (idx, steps, ends)


NODES = "model_id int, node bigint, n double, s double, low double, high double"
CELLS = "model_id int, node bigint, place int, step int, m double, my double"


def _totals(shared, depth: int):
    """Weight, sum and range of the labels of every node of a level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, node, _, m, y, _ in _standing(batch, shared.value[0]) if len(batch) else ():
                here = node >= 1 << depth
                if here.any():
                    frame = pd.DataFrame({"node": node[here], "n": m[here], "s": m[here] * y[here], "y": y[here]}).groupby("node")
                    told = frame.agg(n=("n", "sum"), low=("y", "min"), high=("y", "max")).assign(s=frame["s"].sum(min_count=1), model_id=i)
                    yield pa.RecordBatch.from_pandas(
                        told.reset_index().astype({"model_id": np.int32})[["model_id", "node", "n", "s", "low", "high"]], preserve_index=False
                    )

    return run


def _cells(shared):
    """Sums of weights and of labels per open node, place and step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, wanted = shared.value
            for i, node, rows, m, y, (idx, steps, ends) in _standing(batch, trees) if len(batch) else ():
                here = np.flatnonzero(np.isin(node, wanted[i]))
                nodes, slot = np.unique(node[here], return_inverse=True)
                rows, m, y = rows[here], m[here], y[here]
                counts = ends[rows + 1] - ends[rows]
                own = np.repeat(np.arange(len(rows)), counts)
                if not len(own):
                    continue
                at = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts) + ends[rows][own]
                places = int(idx.max()) + 1
                key, cell = np.unique((slot[own] * places + idx[at]) * (BINS + 1) + steps[at], return_inverse=True)
                place = key // (BINS + 1)
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(key), i, np.int32)),
                        pa.array(nodes[place // places]),
                        pa.array((place % places).astype(np.int32)),
                        pa.array((key % (BINS + 1)).astype(np.int32)),
                        pa.array(np.bincount(cell, m[own])),
                        # Without any label the sum is null, so that no cut sets such rows apart alone.
                        pa.array(np.bincount(cell, np.nan_to_num(m * y)[own]), mask=np.bincount(cell, ~np.isnan(y)[own]) == 0),
                    ],
                    ["model_id", "node", "place", "step", "m", "my"],
                )

    return run


def _best(cells: DataFrame, open_nodes: DataFrame, few: bool) -> DataFrame:
    """``(model_id, node, place, cut)`` of the open nodes ``(model_id, node, n, s)`` that a cut divides.

    The cut leaves the smallest sum of squared errors on both sides, ties going
    to the smaller place, then to the smaller step. Rows without the place are the rest
    of the node, so zeros are never listed. Labels that are whole numbers keep
    all sums exact. With ``few`` nodes their totals are broadcast.
    """
    node = ["model_id", "node"]
    # One shuffle: sums and running sums need the cells of a place together, and tasks summed them already.
    cells = cells.repartition(*node, "place").groupBy(*node, "place", "step").agg(F.sum("m").alias("m"), F.sum("my").alias("my"))
    above = Window.partitionBy(*node, "place").orderBy(F.desc("step"))
    right = cells.select(*node, "place", "step", F.sum("m").over(above).alias("nr"), F.sum("my").over(above).alias("sr"))
    sides = right.join(F.broadcast(open_nodes) if few else open_nodes, node).where("nr < n")
    score = F.expr("sr * sr / nr + (s - sr) * (s - sr) / (n - nr)")
    first = F.struct(score.alias("score"), (-F.col("place")).alias("place"), (-F.col("step")).alias("step"))
    best = sides.groupBy(*node).agg(F.max(first).alias("b"))
    return best.select(*node, (-F.col("b.place")).alias("place"), (-F.col("b.step") - 1).cast("int").alias("cut"))


@dataclass(frozen=True)
class TreeLearner:
    """Regression trees over all places of packed features; all models grow level by level together.

    The rows are written once, with all models that drew them, and stay as they are: a level is a pass in which
    every row finds its node below the cuts so far, and sums per node, place and step are shuffled once. Weights are
    rounded up to 64 steps, so a place has at most 64 cuts in a node. A node whose labels are all
    equal, or whose rows hold the same cells, is a leaf, and its cells are not looked at.
    """

    max_depth: int

    def fit(self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int, near=None) -> list[TreeModel]:
        def step(v: Column) -> Column:
            return F.least(F.greatest(F.ceil(F.round(v * BINS, 6)), F.lit(1)), F.lit(BINS)).cast("int")

        spark = train.sparkSession
        drawn = draws.groupBy(row_id).agg(F.collect_list(F.struct("model_id", F.col("multiplicity").cast("double").alias("m"))).alias("drawn"))
        rows = train.select(row_id, "idx", "val", F.col(label).cast("double").alias("y")).join(drawn, row_id).select(
            "y", "drawn", F.coalesce("idx", F.array().cast("array<int>")).alias("idx"),
            F.coalesce(F.transform("val", step), F.array().cast("array<int>")).alias("steps"),
        )
        rows = materialize(rows, "tree-rows")
        grown, node = [], ["model_id", "node"]
        trees = [(np.zeros(0, np.int64),) * 3] * models
        for depth in range(self.max_depth + 1):
            shared = spark.sparkContext.broadcast((trees, None))
            level = rows.mapInArrow(_totals(shared, depth), NODES).groupBy(*node).agg(
                F.sum("n").alias("n"), F.sum("s").alias("s"), (F.min("low") < F.max("high")).alias("mixed")
            ).toPandas()
            shared.unpersist()
            open_ = level[level["mixed"].fillna(False).astype(bool)]
            cuts = pd.DataFrame({"model_id": [], "node": [], "place": [], "cut": []})
            if len(open_) and depth < self.max_depth:
                wanted = [open_.loc[open_["model_id"] == i, "node"].to_numpy() for i in range(models)]
                shared = spark.sparkContext.broadcast((trees, wanted))
                totals = spark.createDataFrame(open_[[*node, "n", "s"]].astype({"model_id": np.int32}))
                cuts = _best(rows.mapInArrow(_cells(shared), CELLS), totals, len(open_) <= LEVEL_NODES).toPandas()
                shared.unpersist()
            grown.append(level.drop(columns="mixed").merge(cuts, "left", on=node))
            if cuts.empty:
                break
            parts = [cuts[cuts["model_id"] == i] for i in range(models)]
            found = [tuple(np.concatenate([t, p[c].to_numpy(np.int64)]) for t, c in zip(tree, ("node", "place", "cut"))) for tree, p in zip(trees, parts)]
            trees = [tuple(c[np.argsort(t[0])] for c in t) for t in found]
        table = pd.concat(grown)
        table = table.assign(
            place=table["place"].fillna(-1).astype(np.int64), cut=table["cut"].fillna(0).astype(np.int64), value=table["s"] / table["n"]
        )
        return trees_of(table, models)


def trees_of(table: pd.DataFrame, models: int) -> list[TreeModel]:
    """Trees from a table ``(model_id, node, place, cut, value)``."""
    parts = [table[table["model_id"] == i].sort_values("node") for i in range(models)]
    return [TreeModel(*(p[c].to_numpy() for c in ("node", "place", "cut", "value"))) for p in parts]


@dataclass(frozen=True)
class VectorModel:
    """Weights of a linear model on packed features; the last weight is the intercept."""

    weights: np.ndarray

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf("double")
        def linear(idx: pd.Series, val: pd.Series) -> pd.Series:
            w = shared.value
            counts, places, values = _flat(idx, val)
            owner = np.repeat(np.arange(len(counts)), counts)
            return pd.Series(w[-1] + np.bincount(owner, values * w[places], minlength=len(counts)))

        return df.withColumn(out, linear("idx", "val"))


@dataclass(frozen=True)
class TableModel:
    """Weights ``(place, w)`` of a linear model with too many places for one task; place -1 is the intercept."""

    weights: DataFrame
    row_id: str

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        """Rows are told apart by the column ``row_id``; rows that repeat an id repeat its features."""
        sent = sent_weights([self])
        if sent is not None:
            return df.withColumn(out, _fitted_by(df.sparkSession, sent[0])("idx", "val"))
        told = table_margins([self], df).withColumnRenamed("m_0", out)
        return df.join(told, df[self.row_id].eqNullSafe(told["_row"])).drop("_row")


def sent_weights(models: Sequence[TableModel]) -> list[np.ndarray] | None:
    """Weights by place, a 0 for all further places and the constant of each model; none if they take more than ``SENT_BYTES``."""
    tops = [m.weights.agg(F.max("place").alias("top"), F.lit(i).alias("i")) for i, m in enumerate(models)]
    tops = {r.i: max(CONSTANT if r.top is None else r.top, CONSTANT) for r in reduce(DataFrame.union, tops).collect()}
    if sum(8 * (top + 3) for top in tops.values()) > SENT_BYTES:
        return None
    sent = []
    for i, m in enumerate(models):
        told = m.weights.select("place", F.coalesce(F.get("w", F.lit(0)), F.lit(0.0)).alias("w")).toArrow()
        w = np.zeros(tops[i] + 3)
        w[told.column("place").to_numpy()] = told.column("w").to_numpy()
        sent.append(w)
    return sent


def _fitted_by(spark: SparkSession, weights: np.ndarray):
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def linear(idx: pd.Series, val: pd.Series) -> pd.Series:
        w = shared.value
        counts, places, values = _flat(idx, val)
        owner = np.repeat(np.arange(len(counts)), counts)
        return pd.Series(w[CONSTANT] + np.bincount(owner, values * w[np.minimum(places, len(w) - 2)], minlength=len(counts)))

    return linear


def table_margins(models: Sequence[TableModel], df: DataFrame) -> DataFrame:
    """``(_row, m_0, m_1, ...)``: one prediction per id and model, all models by one join."""
    once = df.select(F.col(models[0].row_id).alias("row_id"), "idx", "val").dropDuplicates(["row_id"])
    ids = once.select("row_id", F.explode_outer(F.arrays_zip("idx", "val")).alias("c"))
    cells = ids.select("row_id", F.col("c.idx").alias("place"), "c.val").where("place is not null")
    parts = [m.weights.select("place", F.lit(i).alias("model_id"), F.get("w", F.lit(0)).alias("w")) for i, m in enumerate(models)]
    own = [F.coalesce(F.sum(F.when(F.col("model_id") == i, F.col("w"))), F.lit(0.0)) for i in range(len(models))]
    weights = reduce(DataFrame.union, parts).groupBy("place").agg(F.array(*own).alias("w"))
    return margins(with_constant(cells, once), weights, len(models)).withColumnRenamed("row_id", "_row")


# Columns of what an ascent leaves behind besides the row's id: sums of whole models (``place`` and ``a`` are null), weights, dual variables.
ASCENT = "model_id int, settled boolean, labelled boolean, place bigint, w double, multiplicity bigint, a double"


class _Rows:
    """The drawn rows of one model: their cells in temporary files of the task, the rest in memory."""

    def __init__(self):
        self.idx, self.val, self.met = tempfile.TemporaryFile(), tempfile.TemporaryFile(), np.zeros(0, bool)
        self.counts, self.label, self.cap, self.square, self.ids, self.multiplicity = [], [], [], [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        idx, val, counts, label, cap = (
            x.to_numpy(zero_copy_only=False).astype(t)
            for x, t in (
                (batch.column("idx").flatten(), np.int32), (batch.column("val").flatten(), np.float64),
                (batch.column("idx").value_lengths().fill_null(0), np.int64), (batch.column("label"), np.float64), (batch.column("cap"), np.float64),
            )
        )
        idx.tofile(self.idx)
        val.tofile(self.val)
        if int(idx.max(initial=-1)) >= len(self.met):
            self.met = np.append(self.met, np.zeros(int(idx.max()) + 1 - len(self.met), bool))
        self.met[idx] = True
        square = np.bincount(np.repeat(np.arange(len(counts)), counts), val * val, minlength=len(counts)) + 1.0
        for known, own in zip((self.counts, self.label, self.cap, self.square), (counts, label, cap, square)):
            known.append(own)
        self.ids.append(batch.column("row_id"))
        self.multiplicity.append(batch.column("multiplicity"))

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where the cells of each row begin, and the last one's end; labels, largest dual variables and squared lengths."""
        label, cap, square = (np.concatenate(x) for x in (self.label, self.cap, self.square))
        return np.concatenate([[0], np.cumsum(np.concatenate(self.counts))]), label, cap, square

    def read(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of cells."""
        self.idx.seek(4 * first)
        self.val.seek(8 * first)
        return np.fromfile(self.idx, np.int32, last - first).astype(np.intp), np.fromfile(self.val, np.float64, last - first)


def _pieces(ends: np.ndarray, cells: int) -> list[tuple[int, int]]:
    """Ranges of rows of about equally many cells, at most ``cells`` unless a row has more."""
    each = -(-int(ends[-1]) // max(-(-int(ends[-1]) // cells), 1))
    cuts, n = [0], len(ends) - 1
    while cuts[-1] < n:
        cuts.append(max(int(np.searchsorted(ends, ends[cuts[-1]] + each, "right")) - 1, cuts[-1] + 1))
    return list(zip(cuts[:-1], cuts[1:]))


def _best_constant(gaps: np.ndarray, cap: np.ndarray) -> float:
    """The constant ``b`` with the smallest ``b * b / 2 + sum(cap * abs(b - gaps))``."""
    order = np.argsort(gaps)
    gaps, cap = gaps[order], cap[order]
    # Slopes of the second part between the gaps; the constant stands where both slopes cancel.
    slopes = 2 * np.concatenate([[0.0], np.cumsum(cap)]) - cap.sum()
    before = int(np.searchsorted(gaps + slopes[1:], 0.0))
    if before == len(gaps):
        return float(-slopes[-1])
    return float(min(-slopes[before], gaps[before]))


def _climbed(rows: _Rows, seed: int, cells: int, tolerance: float, passes: int) -> tuple[np.ndarray, float, np.ndarray, bool]:
    """Weights, constant and dual variables of one model, and whether they prove each other within ``tolerance``.

    A dual variable moves to its best value while the others stay, the weights following every step. The rows
    of a piece come in a new order in every sweep, and so do the pieces: in a fixed order the weights settle far later.
    """
    rng = np.random.default_rng(seed)
    ends, label, cap, squares = rows.whole()
    w, constant, a = np.zeros(len(rows.met)), 0.0, np.zeros(len(label))
    large, small = _pieces(ends, cells), _pieces(ends, min(cells, SUMMED_CELLS))
    for _ in range(passes):
        for _ in range(SWEEPS):
            for k in rng.permutation(len(large)).tolist():
                own = slice(*large[k])
                idx, val = rows.read(ends[own.start], ends[own.stop])
                at = (ends[own.start : own.stop + 1] - ends[own.start]).tolist()
                y, most, square, duals = (x[own].tolist() for x in (label, cap, squares, a))
                for r in rng.permutation(len(y)).tolist():
                    i, v, old, m = idx[at[r] : at[r + 1]], val[at[r] : at[r + 1]], duals[r], most[r]
                    met = w.take(i)
                    moved = min(max(old + (y[r] - constant - float(v.dot(met))) / square[r], -m), m)
                    if moved != old:
                        w[i] = met + (moved - old) * v
                        constant += moved - old
                        duals[r] = moved
                a[own] = duals
        gaps = label.copy()
        for first, last in small:
            idx, val = rows.read(ends[first], ends[last])
            owner = np.repeat(np.arange(last - first), np.diff(ends[first : last + 1]))
            gaps[first:last] -= np.bincount(owner, val * w[idx], minlength=last - first)
        square = float(w @ w)
        # The constant of the dual variables is often far from the best one for the other weights.
        best = _best_constant(gaps, cap)
        upper = 0.5 * (square + best * best) + float(cap @ np.abs(gaps - best))
        lower = float(a @ label) - 0.5 * (square + constant * constant)
        if upper - lower <= tolerance * upper:
            return w, best, a, True
    return w, constant, a, False


def _ascended(seed: int, cells: int, tolerance: float, passes: int, schema: pa.Schema):
    """The models whose rows a task has, each climbed to its end: rows of ``ASCENT``."""

    def table(n: int, **columns) -> pa.RecordBatch:
        told = [columns.get(f.name, pa.nulls(n, f.type)) for f in schema]
        return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(told, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: dict[int, _Rows] = {}
        for batch in batches:
            of = batch.column("model_id")
            for m in of.unique().to_pylist():
                models.setdefault(m, _Rows()).add(batch.filter(pc.equal(of, m)))
        for m, rows in models.items():
            label = np.concatenate(rows.label)
            # With a row that has no label no weights are better than others.
            labelled = not np.isnan(label).any()
            if labelled:
                w, constant, a, settled = _climbed(rows, seed, cells, tolerance, passes)
            else:
                w, constant, a, settled = np.zeros(len(rows.met)), 0.0, np.zeros(len(label)), True
            yield table(1, model_id=[m], settled=[settled], labelled=[labelled])
            places, w = np.append(CONSTANT, np.flatnonzero(rows.met)), np.append(constant, w[rows.met])
            for at in range(0, len(places), WRITTEN_ROWS):
                own = slice(at, at + WRITTEN_ROWS)
                yield table(len(places[own]), model_id=np.full(len(places[own]), m), place=places[own], w=w[own])
            done = 0
            for ids, times in zip(rows.ids, rows.multiplicity):
                own = slice(done, done + len(ids))
                done += len(ids)
                yield table(len(ids), model_id=np.full(len(ids), m), row_id=ids, multiplicity=times, a=pa.array(-a[own], mask=np.isnan(label[own])))

    return run


def _blocks(models: int, label: str):
    """Turn a batch of packed rows into one row of binary columns in compressed sparse form."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if f.empty:
                continue
            counts, places, values = _flat(f["idx"], f["val"])
            weight = np.zeros((len(f), models))
            drawn = [(row, d["model_id"], d["multiplicity"]) for row, ds in enumerate(f["drawn"]) for d in ds]
            row, model, times = np.array(drawn, dtype=np.int64).reshape(-1, 3).T
            weight[row, model] = times
            yield pd.DataFrame(
                {
                    "idx": [places.tobytes()],
                    "val": [values.tobytes()],
                    "counts": [counts.tobytes()],
                    "y": [f[label].to_numpy(np.float64).tobytes()],
                    "weight": [weight.tobytes()],
                }
            )

    return pack


# Block bytes per task: small data is not worth many tasks per pass.
TASK_BYTES = 4 << 20
# Partition sums up to this size in total go to the driver at once, larger ones in a tree.
DIRECT_BYTES = 128 << 20

# Weights of all models up to this size are matrices; the driver holds some 45 of them.
WEIGHT_BYTES = 2 << 20
# Weights of all models of a prediction up to this size are sent to the tasks; the rows meet larger ones by a shuffle of their cells.
SENT_BYTES = 64 << 20
# Cells of the rows of a model that a task holds at a time (about 250 MB), cells summed at a time, sweeps before the bounds are taken, and rows of a written batch.
BLOCK_CELLS = 16_000_000
SUMMED_CELLS = 1_000_000
SWEEPS = 2
WRITTEN_ROWS = 1 << 16
# Share of the tolerance that is left to the rounding of sums in another order.
ROUNDING = 1e-6

BLOCK = "idx binary, val binary, counts binary, y binary, weight binary"


def _sums_and_gradient(block, weights: np.ndarray, smooth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over one block for every model and the gradient of the first of them.

    The sums are the weighted smoothed error, the weighted absolute error, and
    the products of slopes with labels and with errors, which the dual objective needs.
    """
    places, models = weights.shape
    idx = np.frombuffer(block["idx"], np.int32)
    val = np.frombuffer(block["val"], np.float64)
    counts = np.frombuffer(block["counts"], np.int64)
    y = np.frombuffer(block["y"], np.float64)
    weight = np.frombuffer(block["weight"], np.float64).reshape(len(y), models)
    owner = np.repeat(np.arange(len(y)), counts)
    gradient = np.zeros((places, models))
    sums = np.zeros((4, models))
    for m in range(models):
        fitted = np.bincount(owner, val * weights[idx, m], minlength=len(y)) + weights[-1, m]
        gap = fitted - y
        root = np.sqrt(gap * gap + smooth[m] * smooth[m])
        slope = weight[:, m] * gap / root
        sums[:, m] = (weight[:, m] * (root - smooth[m])).sum(), (weight[:, m] * np.abs(gap)).sum(), slope @ y, slope @ gap
        gradient[:, m] = np.bincount(idx, val * slope[owner], minlength=places)
        gradient[-1, m] += slope.sum()
    return sums, gradient


def _add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


def _summed(blocks, weights: np.ndarray, smooth: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sums and one gradient per partition; none for an empty partition."""
    parts = (_sums_and_gradient(b, weights, smooth) for b in blocks)
    first = next(parts, None)
    if first is not None:
        yield reduce(_add, parts, first)


def dual_bound(square: float, product: float) -> tuple[float, float]:
    """Share of the slopes, at most 1, that gives the highest dual objective, and that objective."""
    scale = min(max(-product / square, 0.0), 1.0) if square else 0.0
    return scale, -0.5 * scale * scale * square - scale * product


class _Descent:
    """Limited-memory quasi-Newton state of one model and the bounds of its unsmoothed objective.

    Every pass gives a point of the objective (``upper``) and, by its slopes, a
    point of the dual (``lower``). Their distance is half the squared gradient
    of the smoothed objective plus what smoothing costs; when the second part is
    the larger one, the error is smoothed less.
    """

    def __init__(self, start: np.ndarray, smooth: float, memory: int = 20):
        self.point, self.smooth = start, smooth
        self.value, self.slope = None, None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.memory, self.step, self.direction = memory, 1.0, np.zeros(len(start))
        self.upper, self.best = math.inf, start
        self.lower, self.dual_point, self.dual_smooth, self.dual_scale = -math.inf, start, smooth, 0.0
        self.done = False

    def trial(self) -> np.ndarray:
        return self.point + self.step * self.direction

    def _turn(self) -> None:
        q, used = self.slope.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.linalg.norm(q)))
        for (s, y), a in zip(self.pairs, reversed(used)):
            q += (a - (y @ q) / (s @ y)) * s
        self.direction, self.step = -q, 1.0

    def observe(self, sums: np.ndarray, gradient: np.ndarray, c: float, tolerance: float) -> None:
        """Take the sums and their gradient at the trial point: move there, or shorten the step."""
        at = self.trial()
        square = 0.5 * float(at @ at)
        value, slope = square + c * sums[0], at + c * gradient
        upper, (scale, lower) = square + c * sums[1], dual_bound(c * c * float(gradient @ gradient), c * sums[2])
        if upper < self.upper:
            self.upper, self.best = upper, at
        if lower > self.lower:
            self.lower, self.dual_point, self.dual_smooth, self.dual_scale = lower, at, self.smooth, scale
        if self.upper - self.lower <= tolerance * self.upper:
            self.done = True
            return
        if self.value is not None:
            # Near the minimum the fall is smaller than the rounding of a sum over all rows.
            allowed = 1e-4 * self.step * (self.slope @ self.direction) + 1e-12 * abs(self.value)
            if value > self.value + allowed and self.step > 1e-8:
                self.step /= 2
                return
            moved, bend = at - self.point, slope - self.slope
            if moved @ bend > 1e-12:
                self.pairs = [*self.pairs, (moved, bend)][-self.memory:]
        self.point, self.value, self.slope = at, value, slope
        if 0.5 * float(slope @ slope) < c * (sums[1] - sums[3]):
            # The next pass looks at the same point with another objective.
            self.smooth /= 2
            self.value, self.direction = None, np.zeros(len(at))
        else:
            self._turn()


@dataclass(frozen=True)
class SupportVectorLearner:
    """Linear support-vector regression: ``|w|**2 / 2 + c * sum of absolute errors``.

    The descent smooths the absolute error to ``sqrt(r**2 + smooth**2) - smooth``, less
    and less. A model is finished when its objective is proven to be within
    ``tolerance`` of the minimum: the slopes of the errors are a point of the
    dual, whose objective no model can go below. All models share every pass; a
    pass sends out one weight matrix and brings back the gradient summed up.
    Weights over ``WEIGHT_BYTES`` never reach the driver: :meth:`ascend` then climbs the
    dual, each model in a task. ``fit`` fails when the passes run out.
    """

    places: int
    c: float = 1.0
    smooth: float = 0.5
    passes: int = 400
    tolerance: float = 0.01

    def descend(
        self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int, near: VectorModel | None = None
    ) -> list[_Descent]:
        drawn = draws.groupBy(row_id).agg(F.collect_list(F.struct("model_id", "multiplicity")).alias("drawn"))
        rows = train.select(row_id, "idx", "val", label).join(drawn, row_id)
        table = materialize(rows.mapInPandas(_blocks(models, label), BLOCK), "blocks")
        volume = table.agg(F.sum(F.length("idx") + F.length("val"))).first()[0] or 0
        blocks = table.rdd.coalesce(1 + volume // TASK_BYTES).persist()
        sc = train.sparkSession.sparkContext
        direct = blocks.getNumPartitions() * (self.places + 1) * models * 8 <= DIRECT_BYTES
        if near is None:
            start = np.append(np.zeros(self.places), train.agg(F.avg(label)).first()[0])
        else:
            start = near.weights
        states = [_Descent(start.copy(), self.smooth) for _ in range(models)]
        for _ in range(self.passes):
            points, smooth = np.stack([s.trial() for s in states], axis=1), np.array([s.smooth for s in states])
            shared = sc.broadcast(points)
            parts = blocks.mapPartitions(lambda rows, w=shared, e=smooth: _summed(rows, w.value, e))
            if direct:
                sums, gradient = parts.reduce(_add)
            else:
                # Four sums at a time, so that only a handful of gradients reach the driver.
                sums, gradient = parts.treeReduce(_add, max(2, math.ceil(math.log(blocks.getNumPartitions(), 4))))
            shared.destroy()
            for m, state in enumerate(states):
                if not state.done:
                    state.observe(sums[:, m], gradient[:, m], self.c, self.tolerance)
            if all(s.done for s in states):
                break
        blocks.unpersist()
        return states

    def settled(
        self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int, near: VectorModel | None = None
    ) -> list[_Descent]:
        """Finished states only."""
        states = self.descend(train, draws, row_id, label, models, near)
        if not all(s.done for s in states):
            raise RuntimeError(f"support-vector descent not finished after {self.passes} passes")
        return states

    def fit(self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int, near=None) -> list[VectorModel | TableModel]:
        if (self.places + 1) * models * 8 > WEIGHT_BYTES:
            return self.fit_table(train, draws, row_id, label, models)
        return [VectorModel(s.best) for s in self.settled(train, draws, row_id, label, models, near)]

    def fit_table(self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int) -> list[TableModel]:
        """The same models with weights as tables by place."""
        return self.ascend(train, draws, row_id, label, models)[0]

    def ascend(self, train: DataFrame, draws: DataFrame, row_id: str, label: str, models: int) -> tuple[list[TableModel], DataFrame]:
        """Models within ``tolerance`` of their minimum and ``(row_id, model_id, multiplicity, a)``, the dual variables that prove it.

        The drawn rows of a model go to one task, which keeps them in a file and sweeps over their dual variables, piece by
        piece, until the gap is closed: blocks that climb side by side from common weights need many times as many
        sweeps, each with an exchange. A task holds the weights of one model and a piece of ``BLOCK_CELLS``
        cells; the driver sees whether the models are finished.
        """
        drawn = train.select(F.col(row_id).alias("row_id"), "idx", "val", F.col(label).cast("double").alias("label")).join(
            draws.select(F.col(row_id).alias("row_id"), F.col("model_id").cast("int").alias("model_id"), F.col("multiplicity").cast("bigint").alias("multiplicity")), "row_id"
        )
        rows = drawn.withColumn("cap", F.lit(float(self.c)) * F.col("multiplicity")).repartitionById(models, "model_id")
        told = train.select(F.col(row_id).alias("row_id")).schema["row_id"].dataType
        schema = StructType.fromDDL(ASCENT).add("row_id", told)
        climb = _ascended(0, BLOCK_CELLS, self.tolerance * (1 - ROUNDING), self.passes, to_arrow_schema(schema))
        out = materialize(rows.mapInArrow(climb, schema), "svr-models")
        ended = {r.model_id: r for r in out.where("settled is not null").select("model_id", "settled", "labelled").collect()}
        if len(ended) < models:
            raise ValueError("a model without rows to fit")
        if not all(r.settled for r in ended.values()):
            raise RuntimeError(f"support-vector ascent not finished after {self.passes} rounds")
        weights = out.where("place is not null")
        if not all(r.labelled for r in ended.values()):
            # A drawn row without a label: the mean label stands.
            middle = F.lit(train.agg(F.avg(label)).first()[0]).cast("double")
            unlabelled = F.col("model_id").isin([m for m, r in ended.items() if not r.labelled])
            weights = weights.withColumn("w", F.when(unlabelled & (F.col("place") == CONSTANT), middle).otherwise(F.col("w")))
        found = [TableModel(weights.where(F.col("model_id") == m).select("place", F.array("w").alias("w")), row_id) for m in range(models)]
        return found, out.where("multiplicity is not null").select(F.col("row_id").alias(row_id), "model_id", "multiplicity", "a")

    def duals(self, states: Sequence[_Descent], train: DataFrame, draws: DataFrame, row_id: str, label: str) -> DataFrame:
        """``(row_id, model_id, multiplicity, a)``: the dual variable of every drawn row, between minus and plus ``c * multiplicity``."""
        smooth, scale = (
            F.get(F.array(*[F.lit(float(getattr(s, c))) for s in states]), F.col("model_id")) for c in ("dual_smooth", "dual_scale")
        )
        points = predictions([VectorModel(s.dual_point) for s in states], train, row_id)
        gap = F.col("pred") - F.col(label)
        slope = scale * gap / F.sqrt(gap * gap + smooth * smooth)
        return (
            points.join(draws, [row_id, "model_id"])
            .join(train.select(row_id, label), row_id)
            .select(row_id, "model_id", "multiplicity", (F.lit(self.c) * F.col("multiplicity") * slope).alias("a"))
        )


def learner(name: str, *, max_depth: int | None = None, places: int | None = None):
    """Base learner by name: ``line``, ``svr`` or ``tree``."""
    if name == "line":
        return LineLearner()
    if name == "svr":
        if places is None:
            raise ValueError("svr needs the number of places of the features")
        return SupportVectorLearner(places)
    if name == "tree":
        if max_depth is None:
            raise ValueError("tree needs max_depth")
        return TreeLearner(max_depth)
    raise ValueError(f"unknown base learner {name!r}")


def predictions(models: Sequence, df: DataFrame, row_id: str) -> DataFrame:
    """``(row_id, model_id, pred)`` of all models from one scan."""
    names = [f"_p{i}" for i in range(len(models))]
    if models and all(isinstance(m, TableModel) for m in models):
        sent = sent_weights(models)
        if sent is not None:
            df = df.withColumns({n: _fitted_by(df.sparkSession, w)("idx", "val") for n, w in zip(names, sent)})
        else:
            told = table_margins(models, df).withColumnsRenamed({f"m_{i}": n for i, n in enumerate(names)})
            df = df.join(told, df[models[0].row_id].eqNullSafe(told["_row"]))
    else:
        for name, model in zip(names, models):
            df = model.predict(df, name)
    pairs = [F.struct(F.lit(i).alias("model_id"), F.col(name).alias("pred")) for i, name in enumerate(names)]
    return df.select(row_id, F.explode(F.array(*pairs)).alias("_m")).select(row_id, "_m.*")
