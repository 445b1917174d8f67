from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import clustering as C
from tallyloom.operators import projection as P
from tallyloom.operators.matching import best_matching


def points_df(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p], i % 3) for i, p in enumerate(points)], "vec_id long, v array<float>, label int").repartition(3)


def plain_lloyd(points, centers, steps):
    previous, centers = None, centers.copy()
    for _ in range(steps):
        gaps = ((points[:, None, :] - centers[None]) ** 2).sum(-1).round(9)
        cur = gaps.argmin(1)
        for c in range(len(centers)):
            if (cur == c).any():
                centers[c] = points[cur == c].mean(0)
        if previous is not None and (cur == previous).all():
            break
        previous = cur
    return cur


def test_equal_distance_takes_the_lowest_center(spark):
    df = points_df(spark, [[0, 0], [2, 0]])
    centers = np.array([[1.0, 0], [-1, 0], [1, 0]])
    assert {r.vec_id: r.c for r in df.select("vec_id", C.assign("v", centers).alias("c")).collect()} == {0: 0, 1: 0}


@pytest.mark.parametrize("steps", [1, 3, 50])
def test_loop_equals_plain_iterations(spark, steps):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(120, 4)).astype(np.float32).astype(np.float64)
    df = points_df(spark, points)
    runs = C.lloyd(df, "v", [points[:5], points[:3]], steps)
    for run, k in zip(runs, (5, 3)):
        got = dict(df.select("vec_id", C.assign("v", run.used).alias("c")).collect())
        assert [got[i] for i in range(120)] == list(plain_lloyd(points, points[:k], steps))


def test_cost_never_rises(spark):
    points = np.random.default_rng(2).normal(size=(80, 3)).astype(np.float32).astype(np.float64)
    df = points_df(spark, points)
    costs = [C.lloyd(df, "v", [points[:4]], s)[0].cost for s in (1, 2, 4, 8)]
    assert costs == sorted(costs, reverse=True)


def test_empty_cluster_keeps_its_center(spark):
    points = np.array([[0.0, 0], [0, 1], [1, 0]])
    run = C.lloyd(points_df(spark, points), "v", [np.array([[0.0, 0], [100, 100]])], 5)[0]
    assert run.done and list(run.centers[1]) == [100, 100]


def test_vote_ties_and_labels_beyond_k(spark):
    cells = spark.createDataFrame([(0, 1, 5), (0, 0, 5), (1, 7, 9), (1, 1, 1), (2, 8, 4)], "c int, label int, n long")
    got = dict(C.cluster_labels(cells, 3, "voting").select("c", "mapped").collect())
    assert got == {0: 0, 1: 1, 2: 0}
    with pytest.raises(ValueError):
        C.cluster_labels(cells, 3, "other")


@pytest.mark.parametrize("seed", range(4))
def test_matching_equals_all_permutations(spark, seed):
    k = 5
    counts = np.random.default_rng(seed).integers(0, 4 if seed < 2 else 100, size=(k, k))
    cells = spark.createDataFrame([(c, j, int(counts[c, j])) for c in range(k) for j in range(k)], "c int, label int, n long")
    best = max(permutations(range(k)), key=lambda p: (sum(counts[c, j] for c, j in enumerate(p)), [-j for j in p]))
    got = {r.c: r.mapped for r in best_matching(cells, k).collect()}
    assert [got[c] for c in range(k)] == list(best)


def test_zero_filled_grid(spark):
    cells = spark.createDataFrame([(0, 1, 2)], "c int, label int, n long")
    grid = C.zero_filled(cells, 3).collect()
    assert len(grid) == 9 and sum(r.n for r in grid) == 2
    assert C.zero_filled(cells, 3).agg(F.min("n")).first()[0] == 0


def test_spread_centers_follow_the_squared_distance(spark):
    rows = [(i, [float(100 * (i % 3)), 0.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "row long, v array<double>").repartition(5)
    starts = C.spread_centers(df, "row", "v", 5, range(4))
    # Vectors at a center's place are never drawn, so three places give three centers.
    assert [sorted(c[0] for c in s) for s in starts] == [[0.0, 100.0, 200.0]] * 4
    again = C.spread_centers(df.repartition(2), "row", "v", 5, range(4))
    assert all((a == b).all() for a, b in zip(starts, again))
    assert [len(s) for s in C.spread_centers(df.where("row < 0"), "row", "v", 5, [1])] == [0]


def test_far_vectors_are_drawn_as_often_as_their_squared_distance_says(spark):
    rows = [(i, [0.0] if i < 50 else [1.0] if i < 90 else [2.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "row long, v array<double>")
    pairs = [tuple(c.ravel()) for c in C.spread_centers(df, "row", "v", 2, range(200))]
    from_zero = [b for a, b in pairs if a == 0.0]
    # 40 vectors at distance 1 and 10 at distance 2 weigh the same.
    assert 70 <= len(from_zero) <= 130
    assert 0.35 <= sum(b == 2.0 for b in from_zero) / len(from_zero) <= 0.65


def test_axes_equal_a_decomposition_of_all_vectors(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 4)) * [1.0, 5.0, 2.0, 0.1] + [10.0, 0.0, -3.0, 1.0]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(200, None)]
    df = spark.createDataFrame(rows, "row long, v array<double>").repartition(7)
    n, mean, covariance = P.moments(df, "v")
    assert n == 200 and np.allclose(mean, points.mean(axis=0)) and np.allclose(covariance, np.cov(points.T, bias=True))
    axes = P.main_axes(covariance, 2)
    _, _, want = np.linalg.svd(points - points.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(axes @ want[:2].T), np.eye(2)) and (np.abs(axes).max(axis=1) == axes.max(axis=1)).all()
    got = df.select("row", P.coordinate(F.col("v"), mean, axes[0]).alias("x")).collect()
    assert all(r.x == pytest.approx((points[r.row] - mean) @ axes[0]) for r in got if r.row < 200)
    assert [r.x for r in got if r.row == 200] == [None]
    assert P.moments(df.where("row = 200"), "v")[0] == 0


def test_nearest_is_one_product_and_exact_in_close_cases(monkeypatch):
    rng = np.random.default_rng(5)
    points, centers = rng.normal(size=(400, 8)), rng.normal(size=(12, 8))
    centers[7] = centers[3]
    points[:50] = (centers[1] + centers[2]) / 2 + 1e-11 * rng.normal(size=(50, 8))
    points[50] = centers[3]
    gaps = np.stack([((points - c) ** 2).sum(axis=1) for c in centers], axis=1).round(C.DIGITS)
    compared = []
    monkeypatch.setattr(C.np, "stack", lambda rows, axis: compared.append(len(rows[0])) or np.array(rows).T)
    best, gap = C.nearest(points, centers)
    assert list(best) == list(gaps.argmin(axis=1)) and list(gap) == list(gaps.min(axis=1))
    # The points beside two equal centers, or between two, are compared in full, no others.
    assert sum(compared) < 150
