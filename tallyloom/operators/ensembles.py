"""Bagging, boosting and the ways their predictions are combined."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.operators.regressors import predictions
from tallyloom.operators.sampling import bootstrap, drawing_order, weighted_draw
from tallyloom.session import materialize


def bagging(train: DataFrame, row_id: str, label: str, base, n: int, ratio: float, seed: int) -> list:
    """``n`` models, each fitted on ``int(rows * ratio)`` draws with replacement."""
    draws = materialize(bootstrap(train, row_id, ratio, n, seed), "draws")
    return base.fit(train, draws, row_id, label, n)


def single(train: DataFrame, row_id: str, label: str, base) -> list:
    """One model on the training rows themselves."""
    draws = train.select(row_id, F.lit(0).alias("model_id"), F.lit(1).cast("bigint").alias("multiplicity"))
    return base.fit(train, draws, row_id, label, 1)


def mean_prediction(preds: DataFrame, row_id: str) -> DataFrame:
    return preds.groupBy(row_id).agg(F.avg("pred").alias("pred"))


@dataclass
class Boosted:
    """Models with their votes; ``errors`` and ``weights`` record every kept round."""

    models: list
    votes: list[float]
    errors: list[float]
    weights: DataFrame


def boosting_error(sample: DataFrame, label: str) -> tuple[float, float]:
    """Weighted loss of a drawn sample, repeats counted, and the largest absolute error.

    The loss of a row is its absolute error divided by the largest one, a
    constant that can be taken out of the sum, so one aggregate suffices.
    """
    gap = F.abs(F.col("pred") - F.col(label))
    row = sample.agg(F.max(gap).alias("top"), F.sum(F.col("multiplicity") * F.col("w") * gap).alias("loss")).first()
    return (row.loss / row.top if row.top else 0.0), row.top


def reweighted(weights: DataFrame, sample: DataFrame, row_id: str, label: str, beta: float, top: float) -> DataFrame:
    """Weights after a round: drawn rows are multiplied once by ``beta ** (1 - loss)``; not yet scaled."""
    loss = F.abs(F.col("pred") - F.col(label)) / F.lit(top)
    factor = sample.select(row_id, F.pow(F.lit(beta), 1 - loss).alias("_f"))
    return weights.join(factor, row_id, "left").withColumn("w", F.col("w") * F.coalesce("_f", F.lit(1.0))).drop("_f")


def adaboost(train: DataFrame, row_id: str, label: str, base, n: int, ratio: float, seed: int) -> Boosted:
    """Boosting for regression: weighted draws, linear loss, rounds in sequence.

    A round with error 0 or at least 0.5 ends the loop and its model is dropped;
    when it is the very first, the model is kept with vote 1. The weight table is
    written to shared storage after each round.
    """
    order = materialize(drawing_order(train.select(row_id), row_id, seed), "drawing-order")
    weights = order.withColumn("w", F.lit(1.0) / F.col("_n"))
    kept, model = Boosted([], [], [], weights), None
    for i in range(n):
        draws = materialize(weighted_draw(weights, row_id, "w", ratio, seed, i), "draws")
        model = base.fit(train, draws.withColumn("model_id", F.lit(0)), row_id, label, 1, model)[0]
        sample = model.predict(train.join(draws, row_id), "pred").join(weights.select(row_id, "w"), row_id)
        sample = materialize(sample.select(row_id, label, "pred", "multiplicity", "w"), "boosting-sample")
        error, top = boosting_error(sample, label)
        if error <= 0 or error >= 0.5:
            if not kept.models:
                kept.models, kept.votes, kept.errors = [model], [1.0], [error]
            break
        beta = error / (1 - error)
        kept.models.append(model)
        kept.votes.append(math.log(1 / beta))
        kept.errors.append(error)
        if i < n - 1:
            raw = materialize(reweighted(weights, sample, row_id, label, beta, top), "boosting-weights")
            whole = raw.agg(F.sum("w")).first()[0]
            if whole <= 0:
                break
            weights = raw.withColumn("w", F.col("w") / F.lit(whole))
            kept.weights = weights
    return kept


def votes_table(spark: SparkSession, votes: Sequence[float]) -> DataFrame:
    """``(model_id, weight)``, one row per model."""
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(votes)], "model_id int, weight double")


def weighted(preds: DataFrame, votes: DataFrame) -> DataFrame:
    """Predictions with the weight of their model; there is one vote row per model."""
    return preds.join(F.broadcast(votes), "model_id")


def weighted_median(votes: DataFrame, row_id: str) -> DataFrame:
    """Smallest prediction at which the cumulated weight reaches half of the row's total.

    A window holds the models of one row, never more.
    """
    by_row = Window.partitionBy(row_id)
    running = by_row.orderBy("pred", "model_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = votes.select(
        row_id, "pred", F.sum("weight").over(running).alias("_cum"),
        F.sum("weight").over(by_row.orderBy("pred", "model_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    ).where(F.col("_cum") >= 0.5 * F.col("_all"))
    return reached.groupBy(row_id).agg(F.min("pred").alias("pred"))


def boosted_predictions(boosted: Boosted, df: DataFrame, row_id: str) -> DataFrame:
    votes = votes_table(df.sparkSession, boosted.votes)
    return weighted_median(weighted(predictions(boosted.models, df, row_id), votes), row_id)


def soft_vote(probs: DataFrame, row_id: str) -> DataFrame:
    """Mean probability vector per row over models, from rows ``(row_id, model, probs)``."""
    cells = probs.select(row_id, F.posexplode("probs").alias("_pos", "_p"))
    means = cells.groupBy(row_id, "_pos").agg(F.avg("_p").alias("_p"))
    return means.groupBy(row_id).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_p"))), lambda s: s["_p"]).alias("probs")
    )
