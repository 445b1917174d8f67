"""Optimal one-to-one matching of clusters and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_matching(cells: DataFrame, k: int, cluster: str = "c", label: str = "label") -> DataFrame:
    """``(c, mapped, matched)`` maximizing the sum of matched counts.

    ``cells`` holds the full ``k * k`` grid ``(c, label, n)``, which is all that
    is needed of the data and enters the plan as constants. Clusters are
    placed one after the other; for every set of used labels only the best
    partial matching survives, so step ``i`` holds ``choose(k, i)`` rows. Among
    equal sums the lexicographically smallest label list wins.
    """
    counts = {(r[cluster], r[label]): r["n"] for r in cells.collect()}
    states = cells.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("used"), F.lit(0).cast("bigint").alias("score"), F.array().cast("array<int>").alias("path")
    )
    for i in range(k):
        choices = F.array(
            *[
                F.struct(F.lit(j).alias("l"), F.lit(1 << j).cast("bigint").alias("bit"), F.lit(counts[i, j]).cast("bigint").alias("n"))
                for j in range(k)
            ]
        )
        placed = (
            states.withColumn("_c", F.explode(choices))
            .where(F.col("used").bitwiseAND(F.col("_c.bit")) == 0)
            .select(
                F.col("used").bitwiseOR(F.col("_c.bit")).alias("used"),
                (F.col("score") + F.col("_c.n")).alias("score"),
                F.concat("path", F.array("_c.l")).alias("path"),
            )
        )
        states = placed.groupBy("used").agg(F.min_by(F.struct("score", "path"), F.struct(-F.col("score"), F.col("path"))).alias("_s"))
        states = states.select("used", "_s.score", "_s.path")
    return states.select(F.posexplode("path").alias("c", "mapped"), F.col("score").alias("matched"))
