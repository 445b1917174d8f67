import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import sampling as P
from tallyloom.operators.ranking import _in_ranges, last_known, ordered_index, permutation_part, prefix_sum, shuffled_rank
from tallyloom.operators.skew import lookup_join


def md5(*parts):
    return hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()


def permutation(ids, seed):
    return sorted(ids, key=lambda i: (md5(i, seed), i))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 997, 1, 6).withColumnRenamed("id", "row").cache()


IDS = list(range(997))


def test_rank_is_the_sorted_hash_order(rows):
    got = {r.row: r.rk for r in shuffled_rank(rows, "row", 5).collect()}
    assert got == {row: i for i, row in enumerate(permutation(IDS, 5))}


def test_rank_of_string_keys(spark):
    names = [f"k{i}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "row string")
    assert {r.row: r.rk for r in shuffled_rank(df, "row", 1).collect()} == {n: i for i, n in enumerate(permutation(names, 1))}
    parted = permutation_part(df, "row", 1, lambda n: [F.lit(10), F.lit(200), F.lit(0)])
    assert Counter(r.part for r in parted.collect()) == {1: 10, 2: 190}


def test_prefix_sum(rows):
    ranked = shuffled_rank(rows.withColumn("v", F.col("row") % 7), "row", 3, "rk", "n")
    got = {r.row: (r.lo, r.all_sum) for r in prefix_sum(ranked, "rk", "n", "v").collect()}
    running = 0
    for row in permutation(IDS, 3):
        assert got[row] == (running, sum(i % 7 for i in IDS))
        running += row % 7


@pytest.mark.parametrize("ratio", [0.05, 0.5, 0.9999, 1])
def test_sample_is_a_prefix(rows, ratio):
    got = {r.row for r in P.sample_fraction(rows, "row", ratio, 2021).collect()}
    assert got == set(permutation(IDS, 2021)[: int(997 * ratio)])


@pytest.mark.parametrize("ratio", [0.1, 0.0001, 0.99])
def test_tail_holdout(rows, ratio):
    test = {r.row for r in P.holdout_tail(rows, "row", ratio, 7).where("is_test").collect()}
    size = int(997 * ratio)
    assert test == set(permutation(IDS, 7)[997 - size :])


def test_head_holdout(rows):
    train = {r.row for r in P.holdout_head(rows, "row", 0.9, 7).where("is_train").collect()}
    assert train == set(permutation(IDS, 7)[: int(0.9 * 997)])


@pytest.mark.parametrize("k", [1, 5, 10])
def test_folds_and_their_remainder(rows, k):
    folds = {r.row: r.fold for r in P.kfold(rows, "row", k, 3).collect()}
    block = int(997 * (1 / k))
    for rank, row in enumerate(permutation(IDS, 3)):
        assert folds[row] == (rank // block if rank < k * block else None)


def test_fold_of_49_rows_in_49_is_empty(spark):
    folds = P.kfold(spark.range(49).withColumnRenamed("id", "row"), "row", 49, 3).collect()
    assert int(49 * (1 / 49)) == 0 and all(r.fold is None for r in folds)


def test_fold_training_rows(rows):
    folded = P.kfold(rows, "row", 5, 3)
    assert folded.where(P.in_training(F.col("fold"), 2)).count() == 997 - 199


def test_first_shuffled(rows):
    assert {r.row for r in P.first_shuffled(rows, "row", 12, 9).collect()} == set(permutation(IDS, 9)[:12])


@pytest.mark.parametrize("ratio", [0.8, 1.0, 2.5])
def test_bootstrap_matches_plain_draws(rows, ratio):
    got = {(r.model_id, r.row): r.multiplicity for r in P.bootstrap(rows, "row", ratio, 3, 11).collect()}
    order, want = permutation(IDS, 11), Counter()
    for model in range(3):
        for draw in range(int(997 * ratio)):
            want[model, order[int(md5(model, draw, 11)[:15], 16) % 997]] += 1
    assert got == dict(want)


def plain_weighted_draw(weights, ratio, seed, salt):
    order, n = permutation(list(weights), seed), len(weights)
    units = [max(int(weights[r] * 2.0**59 + 0.5), int(weights[r] > 0)) for r in order]
    total, hits = sum(units), Counter()
    for draw in range(int(n * ratio)):
        at = int(md5(salt, draw, seed)[:15], 16) % total
        for row, u in zip(order, units):
            if at < u:
                hits[row] += 1
                break
            at -= u
    return dict(hits)


@pytest.mark.parametrize("shape", ["even", "heavy", "zeros", "tiny"])
def test_weighted_draw_matches_plain_draws(spark, shape):
    n = 300
    raw = {
        "even": [1.0] * n,
        "heavy": [200.0 if i == 17 else 1.0 for i in range(n)],
        "zeros": [0.0 if i % 3 else 1.0 for i in range(n)],
        "tiny": [1e-9 if i % 50 else 1.0 for i in range(n)],
    }[shape]
    weights = {i: w / sum(raw) for i, w in enumerate(raw)}
    df = spark.createDataFrame(list(weights.items()), "row long, w double").repartition(5)
    got = {r.row: r.multiplicity for r in P.weighted_draw(df, "row", "w", 0.8, 4, 2).collect()}
    assert got == plain_weighted_draw(weights, 0.8, 4, 2)
    assert sum(got.values()) == int(n * 0.8)


def test_light_rows_beside_a_heavy_one(spark):
    """99.9 % light rows: all of them can be drawn, none is rounded to nothing, and no range holds most rows."""
    n = 20_000
    raw = [1e6 if i == 77 else 1e6 * (i % 20) if i % 1000 == 1 else 1e-3 for i in range(n)]
    whole = sum(raw)
    df = spark.createDataFrame([(i, w / whole) for i, w in enumerate(raw)], "row long, w double").repartition(5)
    got = {r.row: r.multiplicity for r in P.weighted_draw(df, "row", "w", 0.02, 4, 2).collect()}
    assert got == plain_weighted_draw({i: w / whole for i, w in enumerate(raw)}, 0.02, 4, 2)
    # Each light row has its own stretch of the axis.
    assert 1e-3 / whole * P.WEIGHT_UNITS > 1e6
    axis = df.select((F.col("row") + F.when(F.col("row") > n // 2, 10**15).otherwise(0)).alias("at"), F.lit(0).alias("kind"))
    sizes = [r["count"] for r in _in_ranges(axis, "at", "kind").groupBy("_p").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / len(sizes)


def test_last_known_is_carried_over_ranges(spark):
    rows = [(i, 0 if i % 400 == 150 else 1, f"v{i}" if i % 400 == 150 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "at long, kind int, v string").repartition(5)
    got = {r.at: r.found for r in last_known(df, ["at", "kind"], "v", "found").collect()}
    assert got == {i: f"v{(i - 150) // 400 * 400 + 150}" if i >= 150 else None for i in range(2000)}
    assert last_known(df.where("at < 0"), ["at", "kind"], "v", "found").count() == 0


def test_ordered_index_numbers_without_gaps(spark):
    df = spark.createDataFrame([(f"t{i:04d}", i % 3) for i in range(1000)], "t string, n int").repartition(7)
    got = [(r.t, r.idx) for r in ordered_index(df, F.desc("n"), "t", start=2).orderBy("idx").collect()]
    want = sorted((f"t{i:04d}" for i in range(1000)), key=lambda t: (-(int(t[1:]) % 3), t))
    assert got == [(t, i + 2) for i, t in enumerate(want)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_a_hot_key(spark, how):
    facts = spark.range(9000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("token"))
    table = facts.groupBy("token").agg(F.count("*").alias("n")).where("token <> 'k5'").withColumn("v", F.crc32("token"))
    plain = facts.join(table, "token", how).select("row", "token", "v")
    salted = lookup_join(facts, table, "token", "row", "n", how, limit=0).select("row", "token", "v")
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
