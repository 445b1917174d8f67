import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.vectors import first_argmax
from tallyloom.operators import metrics as M
from tallyloom.operators import naive_bayes as nb

DOCS = [
    (0, "ham", ["a", "b", "a"], False),
    (1, "spam", ["c", "b"], False),
    (2, "ham", [], False),
    (3, "ham", ["a", "zzz", "c"], True),
    (4, "spam", [], True),
    (5, "spam", ["zzz"], True),
]


def inputs(spark, rows=DOCS):
    docs = spark.createDataFrame(rows, "row long, label string, words array<string>, is_test boolean")
    tokens = nb.occurrences(docs, "row", F.col("words"), ["label", "is_test"])
    return docs, tokens, [nb.Variant("v", ~F.col("is_test"), F.col("is_test"))]


def plain_scores(words):
    prior = {"ham": 2 / 3, "spam": 1 / 3}
    freq = {"ham": {"a": 2 / 3, "b": 1 / 3}, "spam": {"c": 1 / 2, "b": 1 / 2}}
    return [math.log(prior[c]) + sum(math.log(freq[c].get(w, 1e-10)) for w in words) for c in ("ham", "spam")]


@pytest.mark.parametrize("limit", [0, 1000])
def test_scores_equal_the_definition_on_both_join_paths(spark, limit):
    docs, tokens, runs = inputs(spark)
    model = nb.fit(docs, tokens, "label", ("ham", "spam"), runs)
    got = {r.row: r.scores for r in nb.score(docs, tokens, model, "row", "label", runs, limit).collect()}
    assert set(got) == {3, 4, 5}
    for row, _, words, test in DOCS:
        if test:
            assert got[row] == pytest.approx(plain_scores(words))


def test_saved_model_is_loaded_again(spark, tmp_path):
    docs, tokens, runs = inputs(spark)
    nb.fit(docs, tokens, "label", ("ham", "spam"), runs, str(tmp_path / "m"))
    model = nb.load(spark, str(tmp_path / "m"), ("ham", "spam"))
    assert model.size.rows == 3 and model.size.key_bytes == 3 and model.totals == {"n_0_0": 3, "n_0_1": 2} and model.documents == {"n_0_0": 2, "n_0_1": 1}


def test_class_without_documents_is_never_chosen(spark):
    docs, tokens, runs = inputs(spark, [r for r in DOCS if r[1] == "ham" or r[3]])
    model = nb.fit(docs, tokens, "label", ("ham", "spam"), runs)
    preds = nb.score(docs, tokens, model, "row", "label", runs).select(first_argmax(F.col("scores")).alias("p")).collect()
    assert {r.p for r in preds} == {0}


def test_tie_goes_to_the_first_class(spark):
    df = spark.createDataFrame([([1.0, 1.0],), ([0.0, 2.0],), ([None, -5.0],)], "s array<double>")
    assert [r[0] for r in df.select(first_argmax(F.col("s"))).collect()] == [0, 1, 1]


def test_fold_variants_equal_separate_trainings(spark):
    rows = [(i, "spam" if i % 3 == 0 else "ham", [f"w{(i * j) % 7}" for j in range(i % 5)], i % 4) for i in range(40)]
    docs = spark.createDataFrame(rows, "row long, label string, words array<string>, fold int")
    tokens = nb.occurrences(docs, "row", F.col("words"), ["label", "fold"])
    runs = [nb.Variant(str(i), F.col("fold") != i, F.col("fold") == i) for i in range(4)]
    model = nb.fit(docs, tokens, "label", ("ham", "spam"), runs)
    together = {(r.variant, r.row): r.scores for r in nb.score(docs, tokens, model, "row", "label", runs).collect()}
    assert len(together) == 40
    for run in runs[:2]:
        alone = nb.fit(docs, tokens, "label", ("ham", "spam"), [run])
        for r in nb.score(docs, tokens, alone, "row", "label", [run]).collect():
            assert together[run.name, r.row] == pytest.approx(r.scores)


@pytest.mark.parametrize(
    "pairs, want",
    [
        ([(0, 1), (0, 0)], (0.5, 0.0, 0.0, 0.0)),
        ([(1, 0), (0, 0)], (0.5, 0.0, 0.0, 0.0)),
        ([(0, 0)], (1.0, 0.0, 0.0, 0.0)),
        ([(1, 1), (1, 0), (0, 1), (1, 1)], (0.5, 2 / 3, 2 / 3, 2 / 3)),
    ],
)
def test_binary_report_with_empty_denominators(spark, pairs, want):
    df = spark.createDataFrame(pairs, "pred int, label int")
    assert tuple(M.binary_report(df, "pred", "label").first()) == pytest.approx(want)


def test_class_report(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (3, 2)]
    df = spark.createDataFrame(pairs, "pred int, label int")
    got = {r["class"]: r for r in M.class_report(df, "pred", "label").collect()}
    assert got["0"].precision == 0.5 and got["0"].recall == 1 and got["0"].support == 1
    assert got["3"].support == 0 and got["3"].recall == 0 and got["3"].f1 == 0
    assert got["accuracy"].f1 == pytest.approx(0.5)
    assert got["macro avg"].precision == pytest.approx((0.5 + 1 + 0.5 + 0) / 4)
    assert got["weighted avg"].recall == pytest.approx((1 * 1 + 3 * (1 / 3) + 2 * 0.5) / 6)


def test_batched_mean_weights_batches_alike(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 0.0)], "id int, v double")
    row = M.batched_mean(df, F.col("v"), F.floor((F.col("id") - 1) / 2)).first()
    assert (row.batches, row["mean"]) == (2, 0.5)
