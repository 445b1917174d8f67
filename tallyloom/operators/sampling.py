"""Seeded shuffles, splits, folds and draws with replacement."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.hashing import hash_key, hash_number
from tallyloom.operators.ranking import last_known, permutation_part, prefix_sum, shuffled_rank
from tallyloom.session import materialize


def _share(n: Column, ratio: float) -> Column:
    return F.floor(n * F.lit(float(ratio)))


def sample_fraction(df: DataFrame, row_id: str, ratio: float, seed: int) -> DataFrame:
    """The first ``int(n * ratio)`` rows of the seeded permutation; 1 keeps everything."""
    if ratio == 1:
        return df
    parted = permutation_part(df, row_id, seed, lambda n: [_share(n, ratio)], "_part")
    return parted.where(F.col("_part") == 0).drop("_part")


def rate_part(
    df: DataFrame, row_id: str, rates: list[float], seed: int, out: str = "part", population: DataFrame | None = None
) -> DataFrame:
    """Number of sampling rates (ascending) whose sample of ``population`` a row is *not* in."""
    return permutation_part(df, row_id, seed, lambda n: [_share(n, r) for r in sorted(rates)], out, population)


def holdout_tail(df: DataFrame, row_id: str, ratio: float, seed: int, out: str = "is_test") -> DataFrame:
    """Mark the last ``int(n * ratio)`` rows of the permutation as test rows."""
    parted = permutation_part(df, row_id, seed, lambda n: [n - _share(n, ratio)], "_part")
    return parted.withColumn(out, F.col("_part") == 1).drop("_part")


def holdout_head(df: DataFrame, row_id: str, ratio: float, seed: int, out: str = "is_train") -> DataFrame:
    """Mark the first ``int(ratio * n)`` rows of the permutation as training rows."""
    parted = permutation_part(df, row_id, seed, lambda n: [_share(n, ratio)], "_part")
    return parted.withColumn(out, F.col("_part") == 0).drop("_part")


def kfold(df: DataFrame, row_id: str, k: int, seed: int, out: str = "fold") -> DataFrame:
    """Test fold of every row; rows left over after ``k`` equal blocks have none.

    A row is training data of all folds but its own. The fold is stored once per
    row instead of writing ``k`` copies of the training data.
    """
    if k < 1:
        raise ValueError("k must be positive")
    block = 1.0 / k
    parted = permutation_part(df, row_id, seed, lambda n: [_share(n, block) * (i + 1) for i in range(k)], "_part")
    return parted.withColumn(out, F.when(F.col("_part") < k, F.col("_part"))).drop("_part")


def in_training(fold: Column, i: int) -> Column:
    return fold.isNull() | (fold != i)


def first_shuffled(df: DataFrame, row_id: str, m: int, seed: int) -> DataFrame:
    """``m`` distinct rows: a top-m by hash, without a full sort."""
    return df.withColumn("_h", hash_key(row_id, seed)).orderBy("_h", row_id).limit(m).drop("_h")


def bootstrap(df: DataFrame, row_id: str, ratio: float, models: int, seed: int) -> DataFrame:
    """``int(n * ratio)`` draws with replacement per model as ``(model_id, row_id, multiplicity)``.

    Draw ``j`` of a model is generated next to the row of rank ``j``, so the
    draws are as spread out as the rows; each one hashes to the rank it picks.
    The ranked ids are needed twice and are written to shared storage once.
    """
    ranked = materialize(drawing_order(df.select(row_id), row_id, seed), "drawing-order")
    rounds = max(1, math.ceil(ratio))
    draws = (
        ranked.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .withColumn("_draw", F.col("_round") * F.col("_n") + F.col("_rk"))
        .where(F.col("_draw") < _share(F.col("_n"), ratio))
        .select("_draw", "_n", F.explode(F.sequence(F.lit(0), F.lit(models - 1))).alias("model_id"))
        .withColumn("_rk", hash_number("model_id", "_draw", seed) % F.col("_n"))
    )
    picks = draws.groupBy("model_id", "_rk").agg(F.count("*").alias("multiplicity"))
    return picks.join(ranked.select("_rk", row_id), "_rk").select("model_id", row_id, "multiplicity")


# All weights together make about this many units, half the range of a drawn number.
WEIGHT_UNITS = 1 << 59


def weighted_draw(df: DataFrame, row_id: str, weight: str, ratio: float, seed: int, salt: int = 0) -> DataFrame:
    """``int(n * ratio)`` draws with replacement, probability proportional to ``weight``; the weights add up to 1.

    Rows and draws are laid on one axis of cumulated weight, in units finer than
    a draw can tell apart; any weight above 0 has at least one. A draw takes the
    last row starting at or before it. The axis is cut into ranges of about equal
    numbers of rows and draws, whatever their weights: neither a very heavy row
    nor many light ones make a large range, and no pairs are formed.

    The columns ``_rk`` and ``_n`` of :func:`drawing_order` are used when the
    rows have them already.
    """
    ranked = df
    if not {"_rk", "_n"} <= set(df.columns):
        ranked = materialize(drawing_order(df.select(row_id, weight), row_id, seed), "drawing-order")
    units = F.floor(F.col(weight) * F.lit(float(WEIGHT_UNITS)) + F.lit(0.5)).cast("bigint")
    units = F.greatest(units, (F.col(weight) > 0).cast("bigint"))
    placed = prefix_sum(ranked.select(row_id, "_rk", "_n", units.alias("_units")), "_rk", "_n", "_units", "_lo", "_whole")
    nothing = F.lit(None).cast(df.schema[row_id].dataType)
    pick = hash_number(F.lit(salt), "_rk", seed) % F.col("_whole")
    ends = F.array(
        F.struct(F.col("_lo").alias("at"), F.lit(0).alias("kind"), F.col(row_id).alias("row"), (F.col("_units") > 0).alias("used")),
        F.struct(pick.alias("at"), F.lit(1).alias("kind"), nothing.alias("row"), (F.col("_rk") < _share(F.col("_n"), ratio)).alias("used")),
    )
    axis = placed.select(F.explode(ends).alias("_e")).where("_e.used").select("_e.at", "_e.kind", "_e.row")
    hits = last_known(axis, ["at", "kind"], "row", row_id).where("kind = 1")
    return hits.groupBy(row_id).agg(F.count("*").alias("multiplicity"))


def drawing_order(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """Columns ``_rk`` and ``_n``: rank in the seeded permutation and row count."""
    return shuffled_rank(df, row_id, seed, "_rk", "_n")
