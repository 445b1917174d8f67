import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions import vectors as V
from tallyloom.operators import ensembles as E
from tallyloom.operators import regressors as G
from tallyloom.operators import sequences as Q
from tallyloom.operators import tfidf
from tallyloom.operators.naive_bayes import counted, occurrences
from tallyloom.session import materialize
from tallyloom.sources import tables as S

TEXTS = ["the cat sat", "the dog sat sat", "a cat and the dog", "", "birds fly over the house"]


def text_df(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "row long, t string")


def plain_tfidf():
    words = [[w for w in t.split() if len(w) > 1] for t in TEXTS]
    df = Counter(w for ws in words for w in set(ws))
    out = {}
    for i, ws in enumerate(words):
        raw = {w: m * (math.log((1 + len(TEXTS)) / (1 + df[w])) + 1) for w, m in Counter(ws).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out.update({(i, w): x / norm for w, x in raw.items()})
    return out


def test_tfidf_equals_the_definition_and_drops_unknown_tokens(spark):
    docs = text_df(spark)
    words = T.word_tokens(F.col("t"))
    vocabulary = tfidf.fit_idf(docs, words, docs.count())
    cells = tfidf.transform(counted(occurrences(docs, "row", words)), vocabulary, "row")
    assert {(r.row, r.token): r.w for r in cells.collect()} == pytest.approx(plain_tfidf())
    shuffled = tfidf.transform(counted(occurrences(docs, "row", words)), vocabulary, "row", (), 0)
    assert {(r.row, r.token): r.w for r in shuffled.collect()} == pytest.approx(plain_tfidf())
    new = spark.createDataFrame([(9, "cat unheard")], "row long, t string")
    got = tfidf.transform(counted(occurrences(new, "row", words)), vocabulary, "row").collect()
    assert [(r.token, r.w) for r in got] == [("cat", 1.0)]


def test_packed_rows_and_narrowed_vocabulary(spark):
    docs = text_df(spark)
    words = T.word_tokens(F.col("t"))
    vocabulary = tfidf.fit_idf(docs, words, docs.count())
    tokens = occurrences(docs, "row", words)
    exact, places = tfidf.numbered(vocabulary)
    assert places == vocabulary.size.rows
    names = {r.idx: r.token for r in exact.table.collect()}
    got = {(r.row, names[i]): v for r in tfidf.packed(tokens, exact, "row").collect() for i, v in zip(r.idx, r.val)}
    assert got == pytest.approx(plain_tfidf())
    shuffled = tfidf.packed(tokens, exact, "row", 0).collect()
    assert {(r.row, names[i]): v for r in shuffled for i, v in zip(r.idx, r.val)} == pytest.approx(plain_tfidf())
    part = tfidf.narrowed(vocabulary, spark.createDataFrame([("cat",), ("dog",), ("cat",), ("new",)], "token string"))
    assert part.size.rows == 2
    for r in tfidf.packed(tokens, tfidf.numbered(part)[0], "row").collect():
        assert max(r.idx) < 2 and sum(v * v for v in r.val) == pytest.approx(1)


def test_hashed_vectors_use_the_same_weights(spark):
    docs = text_df(spark).where("t <> ''")
    rows = tfidf.hashed_features(docs, T.word_tokens(F.col("t")), F.lit(True), 1 << 16).collect()
    n, want = 4, Counter(w for t in TEXTS if t for w in {x for x in t.split() if len(x) > 1})
    for r in rows:
        ws = Counter(w for w in r.t.split() if len(w) > 1)
        raw = sorted(m * (math.log((1 + n) / (1 + want[w])) + 1) for w, m in ws.items())
        norm = math.sqrt(sum(x * x for x in raw))
        assert sorted(r.features.values) == pytest.approx([x / norm for x in raw])


@pytest.mark.parametrize(
    "preds, votes, want",
    [([3.0], [0.2], 3.0), ([2.0, 1.0], [1.0, 1.0], 1.0), ([1.0, 2.0, 3.0], [1.0, 1.0, 5.0], 3.0),
     ([2.0, 2.0, 2.0], [1.0, 2.0, 3.0], 2.0), ([5.0, 1.0, 3.0], [1.0, 1.0, 1.0], 3.0)],
)
def test_weighted_median(spark, preds, votes, want):
    df = spark.createDataFrame([(7, i, p) for i, p in enumerate(preds)], "row long, model_id int, pred double")
    got = E.weighted_median(E.weighted(df, E.votes_table(spark, votes)), "row").collect()
    assert [(r.row, r.pred) for r in got] == [(7, want)]


def line_data(n=60):
    rng = np.random.default_rng(5)
    return [(i, float(i % 13), float(2 * (i % 13) + rng.normal() * 4 + (30 if i % 11 == 0 else 0))) for i in range(n)]


def plain_fit(rows, hits):
    x = np.array([rows[r][1] for r in hits]); y = np.array([rows[r][2] for r in hits]); m = np.array(list(hits.values()), float)
    n, sx, sy = m.sum(), (m * x).sum(), (m * y).sum()
    slope = (n * (m * x * y).sum() - sx * sy) / (n * (m * x * x).sum() - sx * sx)
    return slope, (sy - slope * sx) / n


def test_boosting_equals_plain_rounds(spark):
    from tests.test_sampling import plain_weighted_draw

    rows = line_data()
    train = spark.createDataFrame(rows, "row long, x double, y double")
    got = E.adaboost(train, "row", "y", G.learner("line"), 4, 0.8, 3)
    w, kept = {r[0]: 1 / len(rows) for r in rows}, []
    for i in range(4):
        hits = plain_weighted_draw(w, 0.8, 3, i)
        slope, icept = plain_fit(rows, hits)
        gap = {r: abs(slope * rows[r][1] + icept - rows[r][2]) for r in hits}
        top = max(gap.values())
        error = sum(m * w[r] * gap[r] / top for r, m in hits.items())
        if error <= 0 or error >= 0.5:
            break
        beta = error / (1 - error)
        kept.append((slope, icept, error, math.log(1 / beta)))
        if i < 3:
            for r in hits:
                w[r] *= beta ** (1 - gap[r] / top)
            whole = sum(w.values())
            w = {r: v / whole for r, v in w.items()}
    assert [(m.slope, m.intercept, e, v) for m, e, v in zip(got.models, got.errors, got.votes)] == [pytest.approx(k) for k in kept]
    assert {r.row: r.w for r in got.weights.collect()} == pytest.approx(w)


def test_boosting_keeps_a_perfect_first_model(spark):
    train = spark.createDataFrame([(i, float(i), 2.0 * i + 1) for i in range(20)], "row long, x double, y double")
    exact = E.adaboost(train, "row", "y", G.learner("line"), 3, 1.0, 3)
    assert len(exact.models) >= 1 and exact.models[0].slope == pytest.approx(2.0)
    preds = E.boosted_predictions(exact, train, "row").collect()
    assert {r.row: r.pred for r in preds} == pytest.approx({i: 2.0 * i + 1 for i in range(20)})


def test_boosting_keeps_a_first_model_with_large_error(spark):
    train = spark.createDataFrame([(i, 1.0, float(i % 2)) for i in range(40)], "row long, x double, y double")
    got = E.adaboost(train, "row", "y", G.learner("line"), 3, 0.8, 3)
    assert len(got.models) == 1 and got.votes == [1.0] and got.errors[0] >= 0.5


def test_bagging_mean_lies_between_its_models(spark):
    train = spark.createDataFrame(line_data(), "row long, x double, y double")
    models = E.bagging(train, "row", "y", G.learner("line"), 5, 0.8, 1)
    preds = G.predictions(models, train, "row")
    limits = preds.groupBy("row").agg(F.min("pred").alias("lo"), F.max("pred").alias("hi"))
    for r in E.mean_prediction(preds, "row").join(limits, "row").collect():
        assert r.lo - 1e-9 <= r.pred <= r.hi + 1e-9


def sparse_rows(spark):
    rng = np.random.default_rng(3)
    truth = rng.normal(size=30)
    rows = []
    for i in range(200):
        idx = sorted(rng.choice(30, size=5, replace=False).tolist())
        val = rng.random(5).tolist()
        rows.append((i, idx, val, float(truth[idx] @ val + 3)))
    rows.append((200, None, None, 3.0))
    return rows, spark.createDataFrame(rows, "row long, idx array<int>, val array<double>, y double").repartition(4)


def objective(rows, w, weight):
    gap = np.array([(w[i] @ np.array(v) if i else 0) + w[-1] - y for _, i, v, y in rows])
    return weight * np.abs(gap).sum() + 0.5 * w @ w


def two_weights(train):
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("model_id")
    return train.select("row", both).withColumn("multiplicity", F.col("model_id") + F.lit(1).cast("bigint"))


def test_support_vector_descent(spark):
    rows, train = sparse_rows(spark)
    draws = two_weights(train)
    learner = G.SupportVectorLearner(30)
    states = learner.descend(train, draws, "row", "y", 2)
    duals = learner.duals(states, train, draws, "row", "y").collect()
    assert len(duals) == 2 * len(rows)
    by_row = {r[0]: r for r in rows}
    for m, s in enumerate(states):
        assert s.done and objective(rows, s.best, m + 1) == pytest.approx(s.upper)
        # The dual objective, recomputed from the dual variables, bounds every point from below.
        combined, product = np.zeros(31), 0.0
        for d in (d for d in duals if d.model_id == m):
            assert abs(d.a) <= (m + 1) * (1 + 1e-12)
            _, idx, val, y = by_row[d.row]
            if idx:
                np.add.at(combined, idx, d.a * np.array(val))
            combined[-1] += d.a
            product += d.a * y
        lower = -0.5 * combined @ combined - product
        assert lower == pytest.approx(s.lower)
        assert lower <= s.upper <= lower / 0.99 + 1e-9
        rng = np.random.default_rng(0)
        assert all(objective(rows, s.best + rng.normal(size=31) * 0.02, m + 1) >= lower for _ in range(50))
    preds = G.predictions([G.VectorModel(s.best) for s in states], train, "row").where("model_id = 0").collect()
    got = {r.row: r.pred for r in preds}
    assert got[200] == pytest.approx(states[0].best[-1])
    assert np.mean([abs(got[r[0]] - r[3]) for r in rows]) < 0.2


def test_weights_as_a_table_reach_the_same_minimum(spark, monkeypatch, tmp_path):
    rows, train = sparse_rows(spark)
    learner = G.SupportVectorLearner(30, tolerance=0.05)
    dense = learner.descend(train, two_weights(train), "row", "y", 2)
    monkeypatch.setattr(G, "WEIGHT_BYTES", 0)
    models = learner.fit(train, two_weights(train), "row", "y", 2)
    assert all(type(m) is G.TableModel for m in models)
    for i, (model, state) in enumerate(zip(models, dense)):
        w = np.zeros(31)
        for r in model.weights.collect():
            w[r.place] = r.w[0]
        assert state.lower <= objective(rows, w, i + 1) + 1e-9
        assert objective(rows, w, i + 1) <= state.upper / 0.95 + 1e-9
    S.save_models(spark, models, [1.0, 0.5], str(tmp_path))
    loaded, votes = S.load_models(spark, str(tmp_path))
    assert votes == [1.0, 0.5]
    want = {tuple(r) for r in G.predictions(models, train, "row").collect()}
    assert {tuple(r) for r in G.predictions(loaded, train, "row").collect()} == want and len(want) == 2 * len(rows)


@pytest.mark.parametrize("cells", [10_000, 700])
def test_ascent_in_blocks_is_proven_by_its_dual_variables(spark, monkeypatch, cells):
    rows, train = sparse_rows(spark)
    monkeypatch.setattr(G, "BLOCK_CELLS", cells)
    models, duals = G.SupportVectorLearner(30, passes=60).ascend(train, two_weights(train), "row", "y", 2)
    by_row, duals = {r[0]: r for r in rows}, duals.collect()
    assert len(duals) == 2 * len(rows)
    for m, model in enumerate(models):
        w, combined, product = np.zeros(31), np.zeros(31), 0.0
        for r in model.weights.collect():
            w[r.place] = r.w[0]
        for d in (d for d in duals if d.model_id == m):
            assert abs(d.a) <= d.multiplicity == m + 1
            _, idx, val, y = by_row[d.row]
            if idx:
                np.add.at(combined, idx, d.a * np.array(val))
            combined[-1] += d.a
            product += d.a * y
        lower, upper = -0.5 * combined @ combined - product, objective(rows, w, m + 1)
        assert lower <= upper <= lower / 0.99 + 1e-9


def test_large_weights_need_few_rounds_and_take_repeated_rows(spark, monkeypatch):
    """The descent by tables that the ascent replaced needed more than 20 passes here, and added up the cells of repeated rows."""
    _, train = sparse_rows(spark)
    monkeypatch.setattr(G, "WEIGHT_BYTES", 0)
    models = G.SupportVectorLearner(30, passes=20).fit(train, two_weights(train), "row", "y", 2)
    want = {(r.row, r.model_id): r.pred for r in G.predictions(models, train, "row").collect()}
    got = G.predictions(models, train.union(train), "row").collect()
    assert len(got) == 2 * len(want) and all(r.pred == pytest.approx(want[r.row, r.model_id]) for r in got)
    alone = models[1].predict(train.union(train), "pred").collect()
    assert all(r.pred == pytest.approx(want[r.row, 1]) for r in alone) and len(alone) == len(want)


@pytest.mark.parametrize("cells", [10_000, 300])
def test_an_ascent_is_one_job_without_tables_of_rounds(spark, monkeypatch, cells):
    """Each round of the ascent wrote the weights of all models and read all rows again."""
    rows, train = sparse_rows(spark)
    written = []
    monkeypatch.setattr(G, "BLOCK_CELLS", cells)
    monkeypatch.setattr(G, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    models, duals = G.SupportVectorLearner(30).ascend(train, two_weights(train), "row", "y", 2)
    assert written == ["svr-models"] and duals.count() == 2 * len(rows)
    assert all(sorted(r.place for r in m.weights.collect()) == list(range(-1, 30)) for m in models)


def test_ascent_takes_a_missing_label_repeated_ids_and_text_ids(spark):
    rows, _ = sparse_rows(spark)
    named = [(f"r{i % 150}", idx, val, None if i == 7 else y) for i, idx, val, y in rows]
    train = spark.createDataFrame(named, "row string, idx array<int>, val array<double>, y double")
    draws = spark.createDataFrame([(f"r{i}", m, 1 + i % 2) for i in range(150) for m in (0, 1) if m or i != 7], "row string, model_id int, multiplicity bigint")
    (first, second), duals = G.SupportVectorLearner(30).ascend(train, draws, "row", "y", 2)
    mean = np.mean([y for *_, y in named if y is not None])
    assert {r.place: r.w[0] for r in second.weights.collect()} == {p: pytest.approx(mean) if p < 0 else 0.0 for p in range(-1, 30)}
    assert any(r.w[0] for r in first.weights.collect())
    told = duals.collect()
    assert len(told) == 2 * len(rows) - 2 and all(d.multiplicity == 1 + int(d.row[1:]) % 2 for d in told)
    assert sum(d.a is None for d in told) == 1 and all(not d.a for d in told if d.model_id == 1)


def test_sent_weights_predict_as_the_join_does_without_moving_cells(spark, monkeypatch):
    rows, train = sparse_rows(spark)
    known = [(-1, [3.0]), (4, [0.5]), (7, [None]), (20, [-2.0])]
    models = [G.TableModel(spark.createDataFrame(known[i:], "place bigint, w array<double>"), "row") for i in (0, 1)]
    train = train.union(spark.createDataFrame([(None, [4, 29], [2.0, 1.0], 1.0)], train.schema))
    sent = G.predictions(models, train, "row")
    assert "Generate" in sent._jdf.queryExecution().toString() and "Join" not in sent._jdf.queryExecution().toString()
    got = {(r.row, r.model_id): r.pred for r in sent.collect()}
    alone = {r.row: r.pred for r in models[1].predict(train, "pred").collect()}
    monkeypatch.setattr(G, "SENT_BYTES", 0)
    want = {(r.row, r.model_id): r.pred for r in G.predictions(models, train, "row").collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()} and len(got) == 2 * len(rows) + 2
    assert got[None, 0] == pytest.approx(4.0) and alone == {k: pytest.approx(want[k, 1]) for k in alone}


def test_best_constant_is_the_minimum():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 40):
        gaps, cap = rng.normal(3, 2, n).round(1), rng.integers(1, 4, n).astype(float)
        error = lambda b: b * b / 2 + cap @ np.abs(b - gaps)
        best = G._best_constant(gaps, cap)
        assert all(error(best) <= error(b) + 1e-9 for b in np.append(np.linspace(-9, 9, 999), gaps))


def test_large_gradients_are_summed_in_a_tree(spark, monkeypatch):
    _, train = sparse_rows(spark)
    draws = train.select("row", F.lit(0).alias("model_id"), F.lit(1).cast("bigint").alias("multiplicity"))
    one = G.SupportVectorLearner(30, passes=5).descend(train, draws, "row", "y", 1)[0].upper
    monkeypatch.setattr(G, "DIRECT_BYTES", 0)
    monkeypatch.setattr(G, "TASK_BYTES", 1000)
    assert G.SupportVectorLearner(30, passes=5).descend(train, draws, "row", "y", 1)[0].upper == pytest.approx(one)


def test_too_few_passes_are_an_error(spark):
    _, train = sparse_rows(spark)
    with pytest.raises(RuntimeError):
        G.SupportVectorLearner(30, passes=3).fit(train, two_weights(train), "row", "y", 2)


def tree_rows(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} common", float(i % 7)) for i in range(80)], "row long, t string, y double")
    words = T.word_tokens(F.col("t"))
    vocabulary, _ = tfidf.numbered(tfidf.fit_idf(docs, words, 80))
    return docs.join(tfidf.packed(occurrences(docs, "row", words), vocabulary, "row"), "row", "left"), vocabulary


def test_trees_respect_depth_and_survive_storage(spark, tmp_path):
    train, vocabulary = tree_rows(spark)
    models = E.bagging(train, "row", "y", G.learner("tree", max_depth=3), 3, 0.8, 1)
    assert all(m.depth <= 3 for m in models)
    S.save_models(spark, models, [0.5, 0.25, 0.125], str(tmp_path / "m"), vocabulary)
    loaded, votes = S.load_models(spark, str(tmp_path / "m"))
    assert votes == [0.5, 0.25, 0.125]
    before = {(r.row, r.model_id): r.pred for r in G.predictions(models, train, "row").collect()}
    assert {(r.row, r.model_id): r.pred for r in G.predictions(loaded, train, "row").collect()} == before
    # The stored vocabulary turns a new text into the same features.
    new = spark.createDataFrame([(7, "w0 w2 common")], "row long, t string")
    lists = tfidf.packed(occurrences(new, "row", T.word_tokens(F.col("t"))), S.load_vocabulary(spark, str(tmp_path / "m")), "row")
    assert {r.model_id: r.pred for r in G.predictions(loaded, lists, "row").collect()} == {m: before[7, m] for m in range(3)}


@pytest.mark.parametrize("kind", ["line", "vector"])
def test_other_models_survive_storage(spark, tmp_path, kind):
    models = [G.LineModel(1.5, 0.25)] if kind == "line" else [G.VectorModel(np.array([0.5, -2.0, 3.0]))]
    S.save_models(spark, models, [2.0], str(tmp_path / "m"))
    loaded, votes = S.load_models(spark, str(tmp_path / "m"))
    df = spark.createDataFrame([(0, 2.0, [1], [4.0]), (1, 0.0, None, None)], "row int, x double, idx array<int>, val array<double>")
    got = {r.row: r.pred for r in G.predictions(loaded, df, "row").collect()}
    assert votes == [2.0] and got == ({0: 3.25, 1: 0.25} if kind == "line" else {0: -5.0, 1: 3.0})


def plain_tree(rows, depth, node=1):
    """``rows`` of (cells, weight, label); the nodes as ``{node: (place, step, value)}``."""
    n, s = sum(m for _, m, _ in rows), sum(m * y for _, m, y in rows)
    best = None
    if depth and len({y for _, _, y in rows}) > 1:
        for place, step in sorted({c for cells, _, _ in rows for c in cells.items()}):
            right = [r for r in rows if r[0].get(place, 0) >= step]
            nr, sr = sum(m for _, m, _ in right), sum(m * y for _, m, y in right)
            if nr < n:
                score = sr * sr / nr + (s - sr) * (s - sr) / (n - nr)
                if best is None or score > best[0]:
                    best = (score, place, step)
    if best is None:
        return {node: (-1, 0, s / n)}
    _, place, step = best
    up = [r for r in rows if r[0].get(place, 0) >= step]
    down = [r for r in rows if r[0].get(place, 0) < step]
    return {node: (place, step - 1, s / n)} | plain_tree(down, depth - 1, 2 * node) | plain_tree(up, depth - 1, 2 * node + 1)


def test_trees_equal_plain_recursion(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(90):
        places = sorted(rng.choice(12, size=rng.integers(1, 6), replace=False).tolist())
        rows.append((i, places, rng.random(len(places)).tolist(), float(rng.integers(1, 6))))
    rows += [(90, None, None, 2.0), (91, [], [], 5.0)]
    train = spark.createDataFrame(rows, "row long, idx array<int>, val array<double>, y double")
    draws = train.select("row", F.explode(F.array(F.lit(0), F.lit(1))).alias("model_id")).where("model_id = 0 or row % 3 > 0")
    draws = draws.withColumn("multiplicity", F.when(F.col("model_id") == 1, F.col("row") % 3).otherwise(1))
    models = G.TreeLearner(6).fit(train, draws, "row", "y", 2)
    for model_id, model in enumerate(models):
        drawn = [({p: min(max(math.ceil(v * 64), 1), 64) for p, v in zip(i or [], x or [])}, 1 if model_id == 0 else r % 3, y)
                 for r, i, x, y in rows if model_id == 0 or r % 3]
        want = plain_tree(drawn, 6)
        assert {int(n): (int(p), int(c), v) for n, p, c, v in zip(model.node, model.place, model.cut, model.value)} == want
    got = G.predictions(models[:1], train, "row").collect()
    assert len(got) == 92 and {r.pred for r in got} <= set(models[0].value[models[0].place < 0])


def test_vocabulary_beyond_any_fixed_number_of_places(spark):
    docs = spark.range(300).select(F.col("id").alias("row"), F.expr("transform(sequence(0, 999), i -> concat('t', id * 1000 + i))").alias("t"))
    vocabulary, places = tfidf.numbered(tfidf.fit_idf(docs, F.col("t"), 300))
    assert places == 300_000
    assert vocabulary.table.select("idx").distinct().count() == 300_000


def test_unknown_learners_are_refused():
    for call in (lambda: G.learner("other"), lambda: G.learner("tree"), lambda: G.learner("svr")):
        with pytest.raises(ValueError):
            call()


def test_softmax_and_expected_rating(spark):
    df = spark.createDataFrame([(0, [-1000.0, -1001.0, -1000.0]), (1, [5.0, None, 5.0])], "row long, s array<double>")
    rows = df.select("row", V.softmax(F.col("s")).alias("p")).orderBy("row").collect()
    e = math.exp(-1)
    assert rows[0].p == pytest.approx([1 / (2 + e), e / (2 + e), 1 / (2 + e)])
    assert rows[1].p == pytest.approx([0.5, 0, 0.5])
    got = df.where("row = 1").select(V.expected_rating(V.softmax(F.col("s")))).first()[0]
    assert got == pytest.approx(2.0)


def test_image_rows_are_flattened(spark):
    df = spark.createDataFrame([([[0.0, 1.0], [0.5, 0.25]],)], "r array<array<float>>")
    assert df.select(V.standardize_rows(F.col("r"))).first()[0] == [-0.5, 0.5, 0.0, -0.25]


def test_soft_vote_is_the_elementwise_mean(spark):
    df = spark.createDataFrame([(1, "a", [0.2, 0.8]), (1, "b", [0.6, 0.4]), (2, "a", [1.0, 0.0])], "row long, model string, probs array<double>")
    got = {r.row: r.probs for r in E.soft_vote(df, "row").collect()}
    assert got[1] == pytest.approx([0.4, 0.6]) and got[2] == [1.0, 0.0]


@pytest.mark.parametrize("limit", [0, 1000])
def test_encoding_with_unknown_tokens(spark, limit):
    train = spark.createDataFrame([("b",), ("a",), ("a",), ("c",)], "token string")
    ids = Q.build_ids(train)
    assert {r.token: r.token_id for r in ids.table.collect()} == {"a": 2, "b": 3, "c": 4}
    text = spark.createDataFrame([(1, 0, "c"), (1, 1, "new"), (1, 2, "a")], "row long, pos int, token string")
    assert Q.as_arrays(Q.encode(text, ids, "row", limit=limit), "row").first().input_ids == [4, 1, 2]


def test_truncation_and_padding(spark):
    lists = [list(range(2, 2 + n)) for n in (255, 256, 300, 1)]
    df = spark.createDataFrame([(i, ids, i // 3) for i, ids in enumerate(lists)], "Id int, t array<int>, batch int")
    rows = {r.Id: r for r in Q.padded(df.withColumn("t", Q.truncated(F.col("t"))), "t", "batch").collect()}
    assert [len(rows[i].t) for i in range(4)] == [256, 256, 256, 1]
    assert rows[0].t[-1] == 0 and sum(rows[0].attention_mask) == 255
    assert rows[2].t == list(range(2, 258)) and rows[3].attention_mask == [1]


def test_separator_stays_in_one_piece(spark):
    df = spark.createDataFrame([("Good", "bad[x] ü2")], "s string, r string")
    tokens = df.select(T.sequence_tokens(T.review_text(F.col("s"), F.col("r")))).first()[0]
    assert tokens == ["Good", "[SOS]", "bad", "[", "x", "]", "ü2"]


def test_rating_class_of_text(spark):
    df = spark.createDataFrame([("5.0",), ("1",), (None,)], "o string")
    assert [r[0] for r in df.select(T.rating_class(F.col("o"))).collect()] == [4, 0, None]



def test_trees_write_their_rows_once_and_take_odd_rows(spark, monkeypatch):
    """Rows were written again for every level. A row without a label counts in its node and adds nothing to the sum."""
    written = []
    monkeypatch.setattr(G, "materialize", lambda df, name: written.append(name) or df.localCheckpoint())
    rows = [(i, [0, 1], [1.0, 0.5 + i / 100], float(i % 3)) for i in range(12)] + [(3, [1], [0.2], None), (4, None, None, 2.0)]
    train = spark.createDataFrame(rows, "row long, idx array<int>, val array<double>, y double")
    draws = spark.createDataFrame([(i, 0, 1) for i in range(12)] + [(4, 0, 1)], "row long, model_id int, multiplicity long")
    (model,) = G.TreeLearner(2).fit(train, draws, "row", "y", 1)
    assert written == ["tree-rows"]
    # Rows 3 and 4 come twice, and row 4 is drawn twice: 16 draws, the one without a label among them.
    assert model.value[0] == (sum(i % 3 for i in range(12)) + 1 + 2 * 2) / 16 and model.depth == 2
