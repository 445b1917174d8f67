import numpy as np
import pytest

from tallyloom.operators.regressors import LineModel, predictions
from tallyloom.operators.softmax import CONSTANT, SoftmaxLearner, SoftmaxModel, with_constant
from tallyloom.operators.tfidf import Vocabulary
from tallyloom.operators.skew import measure
from tallyloom.sources import tables as S


def vocabulary(spark, n):
    table = spark.createDataFrame([(f"t{i}", 1, 1.0, i) for i in range(n)], "token string, df bigint, idf double, idx bigint")
    return Vocabulary(table, measure(table, "token"))


def test_store_without_manifest_is_refused(spark, tmp_path):
    with pytest.raises(S.IncompleteStore):
        S.load_models(spark, str(tmp_path / "nothing"))
    path = str(tmp_path / "m")
    S.save_models(spark, [LineModel(1.0, 2.0)], [0.5], path)
    assert not list((tmp_path / "m").glob("manifest/_temporary"))
    for part in (tmp_path / "m" / "manifest").glob("*.parquet"):
        part.rename(tmp_path / part.name)
    with pytest.raises(S.IncompleteStore):
        S.load_models(spark, path)


def test_store_that_breaks_off_leaves_the_older_one(spark, tmp_path):
    path = str(tmp_path)
    S.save_models(spark, [LineModel(1.0, 2.0)], [0.5], path)
    with pytest.raises(AttributeError):
        S.save_models(spark, [LineModel(3.0, 4.0), object()], [1.0, 1.0], path)
    models, votes = S.load_models(spark, path)
    assert votes == [0.5] and [(m.slope, m.intercept) for m in models] == [(1.0, 2.0)]
    S.save_models(spark, [LineModel(5.0, 6.0)], [0.25], path)
    models, votes = S.load_models(spark, path)
    assert votes == [0.25] and models[0].slope == 5.0
    x = spark.createDataFrame([(1, 2.0)], "row int, x double")
    assert predictions(models, x, "row").first().pred == 16.0


def test_store_with_a_cut_vocabulary_is_refused(spark, tmp_path):
    path = str(tmp_path)
    S.save_models(spark, [LineModel(1.0, 2.0)], [1.0], path, vocabulary(spark, 5))
    assert S.load_vocabulary(spark, path).size.rows == 5
    folder = S.manifest(spark, path).folder
    vocabulary(spark, 4).table.write.mode("overwrite").parquet(f"{folder}/vocabulary")
    with pytest.raises(S.IncompleteStore):
        S.load_vocabulary(spark, path)


def test_models_without_a_vocabulary_say_so(spark, tmp_path):
    S.save_models(spark, [LineModel(1.0, 2.0)], [1.0], str(tmp_path))
    with pytest.raises(S.IncompleteStore):
        S.load_vocabulary(spark, str(tmp_path))


def test_votes_have_to_match_the_models(spark, tmp_path):
    for models, votes in (([], []), ([LineModel(1.0, 2.0)], [1.0, 2.0])):
        with pytest.raises(ValueError):
            S.save_models(spark, models, votes, str(tmp_path / "x"))


def newton(x, y, classes, penalty):
    """Dense minimum of the mean loss with a penalty on all weights."""
    n, d = x.shape
    w = np.zeros((classes, d))
    hot = np.eye(classes)[y]
    for _ in range(50):
        z = x @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - hot).T @ x / n + penalty * w
        h = np.zeros((classes, d, classes, d))
        for a in range(classes):
            for b in range(classes):
                s = p[:, a] * ((a == b) - p[:, b])
                h[a, :, b, :] = (x * s[:, None]).T @ x / n
        h = h.reshape(classes * d, -1) + penalty * np.eye(classes * d)
        w = w - np.linalg.solve(h, g.ravel()).reshape(classes, d)
    return w


def test_stored_classifier_scores_new_rows_like_a_dense_minimum(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = np.round(rng.random((40, 6)) * (rng.random((40, 6)) < 0.5), 3)
    y = rng.integers(0, 3, 40)
    rows = spark.createDataFrame([(i, int(c), True) for i, c in enumerate(y)], "row_id bigint, label int, fit boolean")

    def cells(values, ids):
        told = [(i, j, float(v)) for i, r in enumerate(values) for j, v in enumerate(r) if v]
        return with_constant(spark.createDataFrame(told, "row_id bigint, place bigint, val double"), ids)

    fitted = SoftmaxLearner(3, 0.1, 1e-7).fit(rows, cells(x, rows))
    S.save_models(spark, [SoftmaxModel(fitted.weights, 3)], [1.0], str(tmp_path))
    (model,), _ = S.load_models(spark, str(tmp_path))
    assert model.classes == 3 and model.weights.where(f"place = {CONSTANT}").count() == 1
    # The last new row has no known place at all.
    new = np.vstack([np.round(rng.random((5, 6)), 3), np.zeros((1, 6))])
    ids = spark.range(len(new)).withColumnRenamed("id", "row_id")
    w = newton(np.hstack([x, np.ones((40, 1))]), y, 3, 0.1)
    z = np.hstack([new, np.ones((6, 1))]) @ w.T
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    for r in model.probabilities(ids, cells(new, ids)).collect():
        assert np.allclose(r.probs, want[r.row_id], atol=1e-5)
