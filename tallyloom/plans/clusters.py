"""Clustering of labelled vectors: Lloyd loop, label mapping, quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import vectors as V
from tallyloom.operators import clustering as C
from tallyloom.operators import metrics
from tallyloom.operators import projection as P
from tallyloom.operators.sampling import first_shuffled
from tallyloom.plans.views import vectors
from tallyloom.session import materialize, scratch

SEED = 2021
K = 10
BEST_OF = 5
# The loop ends when no vector changes its cluster, and at this many steps at the latest.
STEPS = 300
K_RANGE = tuple(range(5, 20))


def start(spark: SparkSession, sf_dir: str, k: int = K) -> np.ndarray:
    return C.initial_centers(vectors(spark, sf_dir), "vec_id", "embedding", k, SEED)


def assigned(df: DataFrame, centers: np.ndarray) -> DataFrame:
    return df.select("vec_id", "label", C.assign("embedding", centers).alias("c"))


def first_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(vectors(spark, sf_dir), start(spark, sf_dir))


def vector_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return vectors(spark, sf_dir).select(
        "vec_id",
        "label",
        F.size(e).alias("dims"),
        F.round(F.element_at(e, 1).cast("double"), 6).alias("first_value"),
        F.round(V.squared_norm(e), 6).alias("sq_norm"),
    )


def vector_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = vectors(spark, sf_dir).select("vec_id", F.posexplode(V.standardize(F.col("embedding"))).alias("pos", "value"))
    return values.select("vec_id", "pos", F.round("value", 6).alias("value"))


def init_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = first_shuffled(vectors(spark, sf_dir), "vec_id", K, SEED)
    return picked.select("vec_id", "label", F.round(V.total(F.transform("embedding", lambda v: v.cast("double"))), 6).alias("sum_values"))


def assign_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_assignment(spark, sf_dir).select("vec_id", "c")


def update_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = C.cluster_sums(vectors(spark, sf_dir), "embedding", [(0, start(spark, sf_dir), None)])
    return sums.select("c", "n", F.posexplode("sums").alias("pos", "total")).select(
        "c", "pos", F.round(F.col("total") / F.col("n"), 6).alias("mean")
    )


def cluster_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "clusters")
    first_assignment(spark, sf_dir).select("vec_id", "c").write.parquet(path)
    return spark.read.parquet(path)


def stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote and class report of an assignment that was stored and loaded; labels are joined to it again."""
    stored = cluster_store(spark, sf_dir).join(vectors(spark, sf_dir).select("vec_id", "label"), "vec_id")
    named = C.apply_mapping(stored, C.cluster_labels(C.contingency(stored), K, "voting"))
    report = metrics.class_report(named, "pred", "label")
    return report.withColumns({n: F.round(n, 6) for n in ("precision", "recall", "f1")})


def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.contingency(first_assignment(spark, sf_dir))


def contingency_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.zero_filled(contingency(spark, sf_dir), K)


def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cluster_labels(contingency(spark, sf_dir), K, "voting")


def voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = materialize(first_assignment(spark, sf_dir), "assignment")
    return C.apply_mapping(clusters, C.cluster_labels(C.contingency(clusters), K, "voting"))


def apply_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voted(spark, sf_dir).select("vec_id", "c", "label", "pred")


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.class_report(voted(spark, sf_dir), "pred", "label")
    return report.withColumns({n: F.round(n, 6) for n in ("precision", "recall", "f1")})


def optimal_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cluster_labels(contingency(spark, sf_dir), K, "km").select("c", "mapped", "matched")


def kmeans_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vectors(spark, sf_dir)
    run = C.lloyd(points, "embedding", [start(spark, sf_dir)], STEPS)[0]
    return assigned(points, run.used).select("vec_id", "c")


def kmeans_k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote accuracy for every k: all runs share their passes over the vectors."""
    points = vectors(spark, sf_dir)
    widest = start(spark, sf_dir, max(K_RANGE))
    runs = C.lloyd(points, "embedding", [widest[:k] for k in K_RANGE], STEPS)
    columns = [F.struct(F.lit(k).alias("k"), C.assign("embedding", r.used).alias("c")) for k, r in zip(K_RANGE, runs)]
    clusters = points.select("label", F.explode(F.array(*columns)).alias("_r")).select("label", "_r.*")
    cells = clusters.groupBy("k", "c", "label").agg(F.count("*").alias("n"))
    # Labels from k on cannot be chosen; a cluster holding only such labels maps to label 0.
    usable = F.when(F.col("label") < F.col("k"), F.col("n"))
    mapped = cells.groupBy("k", "c").agg(
        F.sum("n").alias("size"),
        F.coalesce(F.max_by(F.when(usable.isNotNull(), F.col("label")), F.when(usable.isNotNull(), F.struct("n", -F.col("label")))), F.lit(0)).alias("mapped"),
    )
    hits = cells.join(F.broadcast(mapped), ["k", "c"]).withColumn("hit", F.when(F.col("label") == F.col("mapped"), F.col("n")).otherwise(0))
    return hits.groupBy("k").agg(F.round(F.sum("hit") / F.sum("n"), 6).alias("accuracy"))


def kmeans_best_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline: the cheapest of five runs from spread-out centers, all runs sharing their passes."""
    points = vectors(spark, sf_dir)
    starts = C.spread_centers(points, "vec_id", "embedding", K, range(BEST_OF))
    runs = C.lloyd(points, "embedding", starts, STEPS)
    # Runs may end in the same clusters, with costs that differ by rounding.
    best = min(runs, key=lambda r: round(r.cost, 6))
    return assigned(points, best.used).select("vec_id", "c")


def project_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two main coordinates of 500 sampled vectors for display, with their clusters."""
    sample = materialize(first_shuffled(vectors(spark, sf_dir), "vec_id", 500, SEED), "display-sample")
    _, mean, covariance = P.moments(sample, "embedding")
    x, y = (P.coordinate(F.col("embedding"), mean, axis) for axis in P.main_axes(covariance, 2))
    cluster = C.assign("embedding", start(spark, sf_dir))
    return sample.select("vec_id", cluster.alias("c"), F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


QUERIES = {
    "vector_scan": vector_scan,
    "vector_normalize": vector_normalize,
    "init_centers": init_centers,
    "assign_cluster": assign_cluster,
    "update_centers": update_centers,
    "cluster_store": cluster_store,
    "stored_report": stored_report,
    "contingency": contingency,
    "contingency_grid": contingency_grid,
    "majority_vote": majority_vote,
    "apply_mapping": apply_mapping,
    "class_report": class_report,
    "optimal_match": optimal_match,
    "kmeans_lloyd": kmeans_lloyd,
    "kmeans_k_sweep": kmeans_k_sweep,
    "kmeans_best_of": kmeans_best_of,
    "project_2d": project_2d,
}
