"""Quality measures; each is one aggregate over aligned predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: smallest probability used in the logarithmic loss.
MIN_PROBABILITY = 1e-15


def aligned(predictions: DataFrame, labels: DataFrame, row_id: str) -> DataFrame:
    return predictions.join(labels, row_id)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is zero where the denominator is."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def accuracy(pred: Column, label: Column) -> Column:
    return F.avg((pred == label).cast("double"))


def binary_counts(df: DataFrame, pred: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """True positives, false positives, false negatives and accuracy; class 1 is positive."""
    p, t = F.col(pred) == 1, F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(p & t).alias("tp"),
        F.count_if(p & ~t).alias("fp"),
        F.count_if(~p & t).alias("fn"),
        accuracy(F.col(pred), F.col(label)).alias("accuracy"),
    )


def binary_report(df: DataFrame, pred: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1; a measure with empty denominator is zero."""
    counts = (
        binary_counts(df, pred, label, by)
        .withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp")))
        .withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    )
    p, r = F.col("precision"), F.col("recall")
    return counts.select(*by, "accuracy", "precision", "recall", ratio(2 * p * r, p + r).alias("f1"))


def class_report(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    The confusion counts are one aggregate with at most classes**2 rows; all
    else works on these.
    """
    cells = df.groupBy(F.col(label).alias("_l"), F.col(pred).alias("_p")).agg(F.count("*").alias("_n"))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("_l").alias("c"), F.col("_n").alias("actual"), F.lit(0).alias("predicted"), hit.alias("hit")),
                F.struct(F.col("_p").alias("c"), F.lit(0).alias("actual"), F.col("_n").alias("predicted"), F.lit(0).alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per_class = (
        sides.groupBy("c")
        .agg(F.sum("actual").alias("support"), F.sum("predicted").alias("_predicted"), F.sum("hit").alias("_hit"))
        .withColumn("precision", ratio(F.col("_hit"), F.col("_predicted")))
        .withColumn("recall", ratio(F.col("_hit"), F.col("support")))
    )
    p, r = F.col("precision"), F.col("recall")
    per_class = per_class.withColumn("f1", ratio(2 * p * r, p + r))
    whole = F.sum("support")
    names = ["precision", "recall", "f1"]
    summary = per_class.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("class"), *[ratio(F.sum("_hit"), whole).alias(n) for n in names], whole.alias("support")
            ),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(n).alias(n) for n in names], whole.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[ratio(F.sum(F.col(n) * F.col("support")), whole).alias(n) for n in names],
                whole.alias("support"),
            ),
        ).alias("rows")
    ).select(F.explode("rows").alias("r")).select("r.*")
    return per_class.select(F.col("c").cast("string").alias("class"), *names, "support").unionByName(summary)


def absolute_and_squared(df: DataFrame, pred: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error and root mean squared error."""
    gap = F.col(label) - F.col(pred)
    return df.groupBy(*by).agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"))


def log_loss(probs: Column, label: Column) -> Column:
    """Mean negative log probability of the true class."""
    return F.avg(-F.ln(F.greatest(F.get(probs, label), F.lit(MIN_PROBABILITY))))


def batched_mean(df: DataFrame, value: Column, batch: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the means of the batches."""
    per_batch = df.groupBy(*by, batch.alias("_batch")).agg(F.avg(value).alias("_mean"))
    return per_batch.groupBy(*by).agg(F.count("*").alias("batches"), F.avg("_mean").alias("mean"))


def mean_over(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Average of metric columns over rows such as folds, as ``(metric, value)``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return df.select(F.explode(pairs).alias("m")).groupBy("m.metric").agg(F.avg("m.value").alias("value"))
