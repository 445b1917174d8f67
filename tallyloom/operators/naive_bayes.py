"""Multinomial naive Bayes as counts, one lookup and one sum.

Several trainings that differ only in which documents or tokens they use
(folds, sampling rates, feature sets) are *variants* of one job: the data is
counted once with one count column per variant and class, and scored once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.skew import BROADCAST_BYTES, Size, lookup_join
from tallyloom.session import scratch

# Fixed value: probability of a token never seen in a class.
UNSEEN = 1e-10


@dataclass(frozen=True)
class Variant:
    """One training and test run.

    ``train`` and ``test`` select documents, ``token`` selects the features used.
    """

    name: str
    train: Column
    test: Column
    token: Column | None = None

    def uses(self, docs: Column) -> Column:
        return docs if self.token is None else docs & self.token


@dataclass(frozen=True)
class Model:
    """Stored parameters: document counts (one row) and token counts (one row per token).

    The few numbers per variant and class are kept at hand: ``documents`` and
    ``totals`` map a count column to its sum, ``size`` measures the token table.
    """

    classes: tuple[str, ...]
    priors: DataFrame
    tokens: DataFrame
    size: Size
    documents: dict[str, int]
    totals: dict[str, int]

    def counts(self, i: int = 0) -> list[str]:
        return [f"n_{i}_{j}" for j in range(len(self.classes))]


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def occurrences(docs: DataFrame, row_id: str, features: Column, keep: Sequence[str] = ()) -> DataFrame:
    """``(row_id, *keep, token)``: one row per token occurrence.

    ``features`` is an array of strings, or of structs with a ``token`` field
    and further fields that are kept apart.
    """
    exploded = docs.select(row_id, *keep, F.explode(features).alias("_f"))
    if isinstance(exploded.schema["_f"].dataType, StructType):
        return exploded.select(row_id, *keep, "_f.*")
    return exploded.withColumnRenamed("_f", "token")


def counted(tokens: DataFrame) -> DataFrame:
    """Occurrences of each token per document as ``m``."""
    return tokens.groupBy(*tokens.columns).agg(F.count("*").alias("m"))


def fit(
    docs: DataFrame, tokens: DataFrame, label: str, classes: Sequence[str], variants: Sequence[Variant], path: str | None = None
) -> Model:
    """Count documents and tokens per variant and class, store both tables, return the model.

    ``tokens`` are occurrences: they are combined to one row per token in each
    task before anything is shuffled.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "naive-bayes")
    names = [[f"n_{i}_{j}" for j in range(len(classes))] for i in range(len(variants))]
    docs.agg(
        *[
            F.count_if(v.train & (F.col(label) == c)).alias(names[i][j])
            for i, v in enumerate(variants)
            for j, c in enumerate(classes)
        ]
    ).write.mode("overwrite").parquet(f"{path}/priors")
    (
        tokens.where(any_of([v.train for v in variants]))
        .groupBy("token")
        .agg(
            F.count("*").alias("seen"),
            *[
                F.count_if(v.uses(v.train) & (F.col(label) == c)).alias(names[i][j])
                for i, v in enumerate(variants)
                for j, c in enumerate(classes)
            ],
        )
        .write.mode("overwrite")
        .parquet(f"{path}/tokens")
    )
    return load(spark, path, classes)


def load(spark: SparkSession, path: str, classes: Sequence[str]) -> Model:
    priors = spark.read.parquet(f"{path}/priors")
    tokens = spark.read.parquet(f"{path}/tokens")
    names = priors.columns
    sums = tokens.agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("token")).alias("bytes"), *[F.sum(c).alias(c) for c in names]
    ).first()
    size = Size(sums["rows"], sums["bytes"] or 0)
    return Model(tuple(classes), priors, tokens, size, priors.first().asDict(), {c: sums[c] or 0 for c in names})


def class_priors(model: Model, i: int = 0) -> list[float | None]:
    """Probability of every class in variant ``i``; missing for a class without documents."""
    counts = [model.documents[c] for c in model.counts(i)]
    return [n / sum(counts) if n else None for n in counts]


def token_probabilities(model: Model, i: int = 0) -> list[Column]:
    """Share of a token among all tokens of each class; missing when never seen there."""
    return [F.when(F.col(c) > 0, F.col(c) / F.lit(model.totals[c] or 1)) for c in model.counts(i)]


def token_log_probabilities(
    counts: DataFrame, model: Model, row_id: str, variants: int = 1, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``counts`` with one column ``lp_<variant>_<class>`` each, the unseen value filled in."""
    pairs = [(i, j) for i in range(variants) for j in range(len(model.classes))]
    logs = {i: token_probabilities(model, i) for i in range(variants)}
    table = model.tokens.select("token", "seen", *[F.ln(logs[i][j]).alias(f"lp_{i}_{j}") for i, j in pairs])
    joined = lookup_join(counts, table, "token", row_id, "seen", size=model.size, limit=limit)
    filled = {f"lp_{i}_{j}": F.coalesce(F.col(f"lp_{i}_{j}"), F.ln(F.lit(UNSEEN))) for i, j in pairs}
    return joined.withColumns(filled).drop("seen")


def score(
    docs: DataFrame,
    tokens: DataFrame,
    model: Model,
    row_id: str,
    label: str,
    variants: Sequence[Variant],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(row_id, label, variant, scores)``: log score of every class for all test documents.

    A document without tokens scores its class priors; the score of a class
    without training documents is missing. With a broadcast model the
    occurrences of a document are summed up where they are; otherwise they are
    counted per document before they are shuffled to the model.
    """
    used = tokens.where(any_of([v.test for v in variants]))
    columns = 2 + len(variants) * len(model.classes)
    used = used.withColumn("m", F.lit(1)) if model.size.fits(columns, limit) else counted(used)
    logs = token_log_probabilities(used, model, row_id, len(variants), limit)
    classes = range(len(model.classes))
    sums = logs.groupBy(row_id).agg(
        *[
            F.sum(F.when(v.uses(v.test), F.col("m") * F.col(f"lp_{i}_{j}"))).alias(f"s_{i}_{j}")
            for i, v in enumerate(variants)
            for j in classes
        ]
    )
    tested = docs.where(any_of([v.test for v in variants])).select(
        row_id, label, *[v.test.alias(f"_t_{i}") for i, v in enumerate(variants)]
    )
    per_variant = []
    for i, v in enumerate(variants):
        priors = [F.lit(None if p is None else math.log(p)).cast("double") for p in class_priors(model, i)]
        per_variant.append(
            F.struct(
                F.lit(v.name).alias("variant"),
                F.col(f"_t_{i}").alias("tested"),
                F.array(*[priors[j] + F.coalesce(F.col(f"s_{i}_{j}"), F.lit(0.0)) for j in classes]).alias("scores"),
            )
        )
    return (
        tested.join(sums, row_id, "left")
        .select(row_id, label, F.explode(F.array(*per_variant)).alias("_v"))
        .select(row_id, label, "_v.*")
        .where("tested")
        .drop("tested")
    )
