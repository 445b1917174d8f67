import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import angle_negatives
from tallyloom.llm.angle_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, idx long, score long, block int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(df):
    rows = hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label")).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def brute(rows, k=5):
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, label, q) in enumerate(usable):
        if i is None or i % 5:
            continue
        scored = []
        for other, (j, theirs, p) in enumerate(usable):
            if other != at and len(p) == len(q):
                scored.append((-sum(a * b for a, b in zip(q, p)), math.inf if j is None else j, j, theirs))
        scored.sort(key=lambda s: s[:2])
        for minus, _, positive, _ in [s for s in scored if s[3] == label][:k]:
            score = -minus
            inside = [(j, -m) for m, _, j, theirs in scored if theirs != label and 80 * score <= -100 * m <= 100 * score][:k]
            out += [(i, positive, rank, j, score, n) for rank, (j, n) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def clustered(count, dim, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((7, dim))
    rows = []
    for i in range(count):
        v = middles[rng.integers(7)] + spread * rng.standard_normal(dim)
        rows.append((i * 3 + 1, (v * rng.uniform(0.2, 2)).tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("block", [7, 64, 4_096])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(angle_negatives, "BLOCK", block)
    monkeypatch.setattr(angle_negatives, "DEAL", 4)
    rows = clustered(260, 8, block)
    df = spark.createDataFrame([(*r, 5, 6, 7) for r in rows], SCHEMA)
    assert found(df) == brute(rows)


def test_bounds_hold_for_every_score():
    rng = np.random.default_rng(3)
    q = np.floor(256 * rng.standard_normal((400, 6)) * rng.uniform(0, 3, (400, 1)))
    q[7], q[9] = 0, q[8] * 2
    frames = {6: angle_negatives._directions(q, 1)}
    import pandas as pd

    batch = pd.DataFrame({"dim": 6, "q": list(q)})
    told = next(angle_negatives._angled(frames)([batch]))
    told = told.assign(idx=range(400), id=range(400), label=0, named=True, angles=[np.asarray(a, np.float32) for a in told["angles"]])
    rows = angle_negatives._Rows.of(told)
    skipped = 0
    for i in range(400):
        low, high = rows.bounds(rows.norm[i], rows.angles[i])
        scores = q @ q[i]
        assert (low <= scores).all() and (scores <= high).all()
        skipped += (high < np.sort(scores)[-5]).sum()
    assert skipped > 0


def test_odd_rows(spark):
    rows = [
        (5, [1.0, 0.5], 1), (6, [1.0, 0.5], 1), (7, [1.0, 0.5], 0), (8, [1.0, 0.5], 0), (None, [1.0, 0.5], 0), (None, [1.0, 0.5], 1),
        (10, [0.0, 0.0], 1), (11, [-1.0, 0.0], 1), (15, [-1.0, -0.25], 0), (16, None, 1), (17, [1.0, None], 1), (18, [float("nan"), 1.0], 0),
        (19, [float("inf"), 1.0], 0), (20, [1.0, 0.5], None), (25, [3.0], 1), (26, [2.0], 1), (27, [2.5], 0), (30, [], 1), (31, [], 0), (32, [], 1),
        (35, [1e6, 0.0], 0), (36, [9e5, 1.0], 0), (37, [8.9e5, 1.0], 1),
    ]
    df = spark.createDataFrame([(*r, 5, 6, 7) for r in rows], SCHEMA)
    assert found(df) == brute(rows)
    assert found(df.limit(0)) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(5, [1.0], 1)] * 3 + [(6, [1.0], 0)] * 2
    got = found(spark.createDataFrame([(*r, 5, 6, 7) for r in rows], SCHEMA))
    # Three anchors, each with the two others as positives, each of these with both negatives.
    assert len(got) == 12 and {g[3] for g in got} == {6}
    huge = [(5, [1e300, 1.0], 1), (6, [1e300, 2.0], 1), (7, [1e299, 1.0], 0)]
    assert len(found(spark.createDataFrame([(*r, 5, 6, 7) for r in huge], SCHEMA))) == 1
