import pytest

import __spark_entry__ as registry
from check import compare, connect
from tallyloom.plans import ratings

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    good, message = compare(spark, con, name, SMALL)
    assert good, message


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() == 1


def test_every_statement_belongs_to_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", ["rating_classifier", "model_select"])
def test_estimators_return_rows(spark, name):
    assert registry.queries()[name](spark, SMALL).count() > 0


def test_text_regressors_stay_in_the_range_of_ratings(spark, monkeypatch):
    monkeypatch.setattr(ratings, "MAX_DEPTH", 3)
    grid = registry.queries()["regression_grid"](spark, SMALL).collect()
    assert len(grid) == 12 and len({(r.run, r.metric) for r in grid}) == 12
    # Ratings lie between 1 and 5; the whole range would be an error of 4.
    assert all(0 < r.value < 2 for r in grid)


def test_stored_models_score_every_document_without_a_label(spark, monkeypatch):
    monkeypatch.setattr(ratings, "MAX_DEPTH", 3)
    rows = registry.queries()["model_store"](spark, SMALL).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    labelled = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert len(rows) == 3 * 2 * len(docs - labelled)
    assert {r.doc_id for r in rows} == docs - labelled and all(r.pred is not None for r in rows)


def test_stored_classifier_rates_every_document_without_a_label(spark):
    rows = registry.queries()["classify_unlabelled"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id", "left_anti").count()
    assert sorted(r.Id for r in rows) == list(range(1, docs + 1))
    assert all(1 <= r.Predicted <= 5 for r in rows) and len({r.Predicted for r in rows}) > docs // 2


def test_class_probabilities_sum_to_one(spark):
    for r in registry.queries()["rating_classifier"](spark, SMALL).collect():
        assert sum(r[f"p_{i}"] for i in range(5)) == pytest.approx(1)
        assert 1 <= r.rating <= 5
