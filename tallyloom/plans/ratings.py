"""Rating regression on reviews: TF-IDF, base learners, bagging and boosting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators import ensembles as E
from tallyloom.operators import metrics, sampling, tfidf
from tallyloom.operators.naive_bayes import counted, occurrences
from tallyloom.operators.regressors import learner, predictions
from tallyloom.plans.views import reviews, table
from tallyloom.session import materialize, scratch
from tallyloom.sources import json_arrays as J
from tallyloom.sources import tables as S

SEED = 2021
TRAIN_RATIO = 0.9
MODELS = 5
RATIO = 0.8
ROUNDS = 3
MAX_DEPTH = 20
BOOST_DEPTH = 4


def split_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.holdout_head(reviews(spark, sf_dir), "doc_id", TRAIN_RATIO, SEED)


# ---- TF-IDF -----------------------------------------------------------------


def tfidf_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents").select(F.explode(T.word_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def review_tokens(split: DataFrame) -> DataFrame:
    return occurrences(split, "doc_id", T.word_tokens(F.col("review")), ["is_train"])


def train_vocabulary(split: DataFrame) -> tfidf.Vocabulary:
    train = split.where("is_train")
    return tfidf.fit_idf(train, T.word_tokens(F.col("review")), train.count())


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_reviews(spark, sf_dir)
    return train_vocabulary(split).table.select("token", "df", F.round("idf", 9).alias("idf"))


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_reviews(spark, sf_dir)
    cells = tfidf.transform(counted(review_tokens(split)), train_vocabulary(split), "doc_id", ("is_train",))
    return cells.select("doc_id", "is_train", "token", F.round("w", 9).alias("w"))


def rating_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).select("doc_id", T.rating(F.col("overall")).alias("rating"))


# ---- draws ------------------------------------------------------------------


def bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bootstrap(table(spark, sf_dir, "documents"), "doc_id", RATIO, MODELS, SEED)


def bootstrap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawn reviews with their repeats."""
    source = reviews(spark, sf_dir).select("doc_id", "overall")
    draws = sampling.bootstrap(source, "doc_id", RATIO, MODELS, SEED)
    repeated = draws.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("multiplicity").cast("int"))))
    return repeated.join(source, "doc_id").select("model_id", "doc_id", "overall", "copy")


def weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws with a chance proportional to the length of the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    whole = docs.agg(F.sum("n_chars")).first()[0]
    weights = docs.select("doc_id", (F.col("n_chars").cast("double") / F.lit(float(whole))).alias("w"))
    return sampling.weighted_draw(weights, "doc_id", "w", RATIO, SEED)


# ---- ensembles with a closed-form base learner ------------------------------


def lined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test reviews with the text length as the only feature."""
    split = split_reviews(spark, sf_dir).select(
        "doc_id", "is_train", F.col("n_chars").cast("double").alias("x"), T.rating(F.col("overall")).alias("y")
    )
    return split.where("is_train").drop("is_train"), split.where(~F.col("is_train")).drop("is_train")


def bagged_lines(spark: SparkSession, sf_dir: str):
    train, test = lined(spark, sf_dir)
    return E.bagging(train, "doc_id", "y", learner("line"), MODELS, RATIO, SEED), test


def bagging_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    models, _ = bagged_lines(spark, sf_dir)
    rows = [(i, m.slope, m.intercept) for i, m in enumerate(models)]
    df = spark.createDataFrame(rows, "model_id int, slope double, intercept double")
    return df.select("model_id", F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"))


def ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    models, test = bagged_lines(spark, sf_dir)
    mean = E.mean_prediction(predictions(models, test, "doc_id"), "doc_id")
    return mean.select("doc_id", F.round("pred", 6).alias("pred"))


def mae_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    models, test = bagged_lines(spark, sf_dir)
    mean = E.mean_prediction(predictions(models, test, "doc_id"), "doc_id")
    report = metrics.absolute_and_squared(metrics.aligned(mean, test, "doc_id"), "pred", "y")
    return report.select(F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


def boosted_lines(spark: SparkSession, sf_dir: str, rounds: int = ROUNDS):
    train, test = lined(spark, sf_dir)
    return E.adaboost(train, "doc_id", "y", learner("line"), rounds, RATIO, SEED), test


def adaboost_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    boosted, _ = boosted_lines(spark, sf_dir)
    rows = [(i, m.slope, m.intercept, e, v) for i, (m, e, v) in enumerate(zip(boosted.models, boosted.errors, boosted.votes))]
    df = spark.createDataFrame(rows, "model_id int, slope double, intercept double, error double, weight double")
    digits = {"slope": 9, "intercept": 6, "error": 6, "weight": 6}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def boost_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error, beta and vote of the first round."""
    boosted, _ = boosted_lines(spark, sf_dir, 1)
    error = boosted.errors[0]
    df = spark.createDataFrame([(error, error / (1 - error), boosted.votes[0])], "error double, beta double, weight double")
    return df.withColumns({c: F.round(c, 6) for c in df.columns})


def boost_reweight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row weights after the first of two rounds, per mille."""
    boosted, _ = boosted_lines(spark, sf_dir, 2)
    return boosted.weights.select("doc_id", F.round(F.col("w") * 1000, 6).alias("w"))


def weighted_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    boosted, test = boosted_lines(spark, sf_dir)
    votes = E.votes_table(spark, boosted.votes)
    rows = E.weighted(predictions(boosted.models, test, "doc_id"), votes)
    return rows.select("doc_id", "model_id", F.round("pred", 6).alias("pred"), F.round("weight", 6).alias("weight"))


def weighted_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    boosted, test = boosted_lines(spark, sf_dir)
    return E.boosted_predictions(boosted, test, "doc_id").select("doc_id", F.round("pred", 6).alias("pred"))


# ---- regressors on text -----------------------------------------------------


def packed_reviews(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tfidf.Vocabulary, int]:
    """``(doc_id, part, y, idx, val)`` with part ``train`` or ``test``, the numbered vocabulary of the training reviews and its places."""
    split = split_reviews(spark, sf_dir).withColumn("y", T.rating(F.col("overall")))
    split = split.withColumn("part", F.when(F.col("is_train"), "train").otherwise("test"))
    vocabulary, places = tfidf.numbered(train_vocabulary(split))
    lists = tfidf.packed(review_tokens(split), vocabulary, "doc_id")
    rows = materialize(split.select("doc_id", "part", "y").join(lists, "doc_id", "left"), "text-features")
    return rows, vocabulary, places


def text_features(spark: SparkSession, sf_dir: str, base: str) -> tuple[DataFrame, DataFrame, object]:
    """Rows to fit, test rows and the base learner for ``svr`` or ``tree``."""
    rows, _, places = packed_reviews(spark, sf_dir)
    fitted = learner("tree", max_depth=MAX_DEPTH) if base == "tree" else learner("svr", places=places)
    return rows.where("part = 'train'"), rows.where("part = 'test'"), fitted


def text_model(train: DataFrame, test: DataFrame, fitted, method: str) -> DataFrame:
    """``(doc_id, y, pred)`` on the test reviews by one ensemble method."""
    if method == "boosting":
        preds = E.boosted_predictions(E.adaboost(train, "doc_id", "y", fitted, MODELS, RATIO, SEED), test, "doc_id")
    elif method == "bagging":
        models = E.bagging(train, "doc_id", "y", fitted, MODELS, RATIO, SEED)
        preds = E.mean_prediction(predictions(models, test, "doc_id"), "doc_id")
    elif method == "single":
        preds = E.mean_prediction(predictions(E.single(train, "doc_id", "y", fitted), test, "doc_id"), "doc_id")
    else:
        raise ValueError(f"unknown method {method!r}")
    return metrics.aligned(preds, test.select("doc_id", "y"), "doc_id").select("doc_id", "y", "pred")


def linear_svr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_model(*text_features(spark, sf_dir, "svr"), "single")


def svr_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof that bagged support-vector models stand within 1 % of their minimum.

    ``(model_id, draws, reviews, bounded, settled)``. Weights and one dual variable
    per drawn review are stored and read back; objective and dual objective
    are summed from these tables alone. A dual variable never exceeds the
    penalty of its draws, and the dual objective is below every objective, so
    a small gap proves the model.
    """
    train, _, fitted = text_features(spark, sf_dir, "svr")
    draws = materialize(sampling.bootstrap(train, "doc_id", RATIO, MODELS, SEED), "draws")
    proven, duals = fitted.ascend(train, draws, "doc_id", "y", MODELS)
    path = scratch(spark, "certificate")
    S.save_models(spark, proven, [1.0] * MODELS, path)
    # Reviews whose id is repeated count once for every row with that id.
    duals.join(train.select("doc_id"), "doc_id").write.parquet(f"{path}/duals")
    duals = spark.read.parquet(f"{path}/duals")
    weights = spark.read.parquet(S.manifest(spark, path).table)
    models, _ = S.load_models(spark, path)
    gaps = predictions(models, train, "doc_id").join(duals, ["doc_id", "model_id"]).join(train.select("doc_id", "y"), "doc_id")
    told = gaps.groupBy("model_id").agg(
        F.sum("multiplicity").alias("draws"),
        F.count("*").alias("reviews"),
        F.every(F.abs("a") <= fitted.c * F.col("multiplicity") + 1e-9).alias("bounded"),
        F.sum(fitted.c * F.col("multiplicity") * F.abs(F.col("pred") - F.col("y"))).alias("errors"),
        F.sum(F.col("a") * F.col("y")).alias("product"),
        F.sum("a").alias("constant"),
    )
    cells = train.select("doc_id", F.explode(F.arrays_zip("idx", "val")).alias("c")).join(duals.select("doc_id", "model_id", "a"), "doc_id")
    combined = cells.groupBy("model_id", "c.idx").agg(F.sum(F.col("a") * F.col("c.val")).alias("v"))
    combined = combined.groupBy("model_id").agg(F.sum(F.col("v") * F.col("v")).alias("combined"))
    square = weights.groupBy("model_id").agg(F.sum(F.get("w", F.lit(0)) * F.get("w", F.lit(0))).alias("square"))
    upper = 0.5 * F.col("square") + F.col("errors")
    lower = -0.5 * (F.col("combined") + F.col("constant") * F.col("constant")) - F.col("product")
    settled = (upper - lower <= (fitted.tolerance + 1e-9) * upper) & (lower <= upper)
    return told.join(combined, "model_id").join(square, "model_id").select("model_id", "draws", "reviews", "bounded", settled.alias("settled"))


def tree_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_model(*text_features(spark, sf_dir, "tree"), "single")


def bagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_model(*text_features(spark, sf_dir, "svr"), "bagging")


def adaboost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_model(*text_features(spark, sf_dir, "svr"), "boosting")


def bagging_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of trees, each grown on its own draws."""
    rows = text_model(*text_features(spark, sf_dir, "tree"), "bagging")
    return rows.withColumn("pred", F.round("pred", 6))


def adaboost_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted median of boosted trees, shallow so that a small table does not end the rounds with an error of 0."""
    train, test, _ = text_features(spark, sf_dir, "tree")
    boosted = E.adaboost(train, "doc_id", "y", learner("tree", max_depth=BOOST_DEPTH), ROUNDS, RATIO, SEED)
    return E.boosted_predictions(boosted, test, "doc_id").select("doc_id", F.round("pred", 6).alias("pred"))


def regression_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute and root mean squared error of every method with every base learner."""
    path = scratch(spark, "grid")
    for base in ("svr", "tree"):
        inputs = text_features(spark, sf_dir, base)
        for method in ("single", "bagging", "boosting"):
            quality = metrics.absolute_and_squared(text_model(*inputs, method), "pred", "y").first()
            S.append_metrics(spark, path, f"{method}_{base}", quality.asDict())
    return spark.read.parquet(path)


def unlabelled_features(spark: SparkSession, sf_dir: str, vocabulary: tfidf.Vocabulary) -> DataFrame:
    """``(doc_id, x, idx, val)`` of all documents without a label, on the places of a stored vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review"), F.col("n_chars").cast("double").alias("x"))
    new = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    lists = tfidf.packed(occurrences(new, "doc_id", T.word_tokens(F.col("review"))), vocabulary, "doc_id")
    return materialize(new.select("doc_id", "x").join(lists, "doc_id", "left"), "new-features")


def predict_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result file ``(Id, Predicted)`` of all documents without a label, in the order of their ids.

    Boosted trees, their votes and vocabulary are stored, and only what is read back from the store scores the documents.
    """
    rows, vocabulary, _ = packed_reviews(spark, sf_dir)
    trees = learner("tree", max_depth=BOOST_DEPTH)
    boosted = E.adaboost(rows.where("part = 'train'"), "doc_id", "y", trees, ROUNDS, RATIO, SEED)
    path = scratch(spark, "boosted")
    S.save_models(spark, boosted.models, boosted.votes, path, vocabulary)
    models, votes = S.load_models(spark, path)
    new = unlabelled_features(spark, sf_dir, S.load_vocabulary(spark, path))
    preds = E.weighted_median(E.weighted(predictions(models, new, "doc_id"), E.votes_table(spark, votes)), "doc_id")
    return S.submitted(preds, "doc_id", "pred", scratch(spark, "unlabelled")).withColumn("Predicted", F.round("Predicted", 6))


def model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of every base learner and their vocabulary stored, loaded again, and applied to documents without a label.

    ``(base, doc_id, model_id, pred)``.
    """
    rows, vocabulary, places = packed_reviews(spark, sf_dir)
    fit_rows = rows.where("part = 'train'")
    lines, _ = lined(spark, sf_dir)
    path = scratch(spark, "models")
    for base, train in (("line", lines), ("svr", fit_rows), ("tree", fit_rows)):
        fitted = learner(base, max_depth=MAX_DEPTH, places=places)
        models = E.bagging(train, "doc_id", "y", fitted, 2, RATIO, SEED)
        S.save_models(spark, models, [1.0, 1.0], f"{path}/{base}", None if base == "line" else vocabulary)
    new = unlabelled_features(spark, sf_dir, S.load_vocabulary(spark, f"{path}/svr"))
    parts = []
    for base in ("line", "svr", "tree"):
        models, _ = S.load_models(spark, f"{path}/{base}")
        parts.append(predictions(models, new, "doc_id").select(F.lit(base).alias("base"), "doc_id", "model_id", "pred"))
    return parts[0].union(parts[1]).union(parts[2])


# ---- files ------------------------------------------------------------------

REVIEW_FIELDS = ["doc_id", "review", "summary", "overall"]


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written as JSON lines, and once more as files of one JSON array each, both read back."""
    source = reviews(spark, sf_dir, labelled=False).select(F.col("doc_id").cast("string").alias("doc_id"), *REVIEW_FIELDS[1:])
    lines, arrays = scratch(spark, "reviews-json"), scratch(spark, "reviews-array")
    S.write_json(source, lines)
    as_lines = spark.read.schema(S.string_schema(REVIEW_FIELDS)).json(lines)
    J.write_json_array(as_lines, arrays)
    back = J.read_json_array(spark, arrays, S.string_schema(REVIEW_FIELDS))
    return back.select("doc_id", "overall", "summary", F.md5(F.col("review").cast("binary")).alias("review_md5"))


def tab_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a review file, an unrated one with an empty rating: complete, short, with surplus fields, with trailing empty fields, with quotes."""
    flat: Column = F.regexp_replace("review", r"\s+", " ")
    fields = [F.col("doc_id").cast("string"), flat, F.regexp_replace("summary", r"\s+", " "), F.coalesce("overall", F.lit(""))]
    shape = F.col("doc_id") % 5
    line = (
        F.when(shape == 0, F.concat_ws("\t", *fields))
        .when(shape == 1, F.concat_ws("\t", *fields[:2]))
        .when(shape == 2, F.concat_ws("\t", *fields, F.lit("surplus"), F.lit("more")))
        .when(shape == 3, F.concat_ws("\t", fields[0], F.lit("short text"), F.lit(""), F.lit("")))
        .otherwise(F.concat_ws("\t", fields[0], F.concat(F.lit('"'), flat), F.lit('in "quotes"'), F.lit('5"')))
    )
    return reviews(spark, sf_dir, labelled=False).select(line.alias("value"))


def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "reviews-tsv")
    tab_lines(spark, sf_dir).write.text(path)
    rows = S.read_tab_separated(spark, path, "\t".join(REVIEW_FIELDS))
    return rows.select("doc_id", F.md5(F.col("review").cast("binary")).alias("review_md5"), "summary", "overall")


def metric_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "metrics")
    train, test = lined(spark, sf_dir)
    for name, models in (
        ("single", E.single(train, "doc_id", "y", learner("line"))),
        ("bagging", E.bagging(train, "doc_id", "y", learner("line"), MODELS, RATIO, SEED)),
    ):
        mean = E.mean_prediction(predictions(models, test, "doc_id"), "doc_id")
        quality = metrics.absolute_and_squared(metrics.aligned(mean, test, "doc_id"), "pred", "y").first()
        S.append_metrics(spark, path, name, quality.asDict())
    return spark.read.parquet(path).select("run", "metric", F.round("value", 6).alias("value"))


QUERIES = {
    "tfidf_tokens": tfidf_tokens,
    "idf": idf,
    "tfidf": tf_idf,
    "rating_cast": rating_cast,
    "bootstrap": bootstrap,
    "bootstrap_rows": bootstrap_rows,
    "weighted_draw": weighted_draw,
    "bagging_ols": bagging_ols,
    "ensemble_mean": ensemble_mean,
    "mae_rmse": mae_rmse,
    "adaboost_ols": adaboost_ols,
    "boost_error": boost_error,
    "boost_reweight": boost_reweight,
    "weighted_votes": weighted_votes,
    "weighted_median": weighted_median,
    "linear_svr": linear_svr,
    "svr_certificate": svr_certificate,
    "tree_regressor": tree_regressor,
    "bagging": bagging,
    "adaboost": adaboost,
    "bagging_trees": bagging_trees,
    "adaboost_trees": adaboost_trees,
    "regression_grid": regression_grid,
    "model_store": model_store,
    "predict_unlabelled": predict_unlabelled,
    "json_roundtrip": json_roundtrip,
    "tsv_scan": tsv_scan,
    "metric_store": metric_store,
}
