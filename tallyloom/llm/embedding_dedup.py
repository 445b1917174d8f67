"""Near-duplicate vectors: sign hashes in several tables, exact cosines, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import connected_components, keep, local_components

# Expected vectors in a bucket; buckets are compared as matrix products.
BUCKET = 256
# Vectors of a bucket that one task holds at most on either side.
BLOCK = 2_048


def table_plan(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits per table and number of tables for ``rows`` vectors.

    Two vectors at the threshold agree in one sign with probability
    ``1 - angle / pi``. Tables are added until a pair at the very threshold
    shares at least one bucket with the wanted probability, whatever the rows.
    """
    bits = max(4, math.ceil(math.log2(max(rows, 1) / BUCKET))) if rows > BUCKET else 4
    shared = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - shared)))


def _signer(bits: int, tables: int, seed: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            found = [np.zeros((0, tables), np.int64)] * len(batch)
            sizes = batch["vec"].map(len).to_numpy()
            for dim in np.unique(sizes):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((dim, tables * bits))
                rows = np.flatnonzero(sizes == dim)
                side = np.stack([np.asarray(batch["vec"].iloc[r], np.float64) for r in rows]) @ planes[dim] > 0
                keys = side.reshape(len(rows), tables, bits) @ weights
                for r, k in zip(rows, keys):
                    found[r] = k
            yield batch.assign(sig=found, dim=sizes)

    return sign


def _comparer(threshold: float):
    def compare(key, group: pd.DataFrame) -> pd.DataFrame:
        table, _, _, low, high = key
        vectors = np.stack([np.asarray(v, np.float64) for v in group["vec"]])
        norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        block = group["block"].to_numpy()
        one, two = (np.arange(len(group)),) * 2 if low == high else (np.flatnonzero(block == low), np.flatnonzero(block == high))
        close = vectors[one] @ vectors[two].T >= threshold * np.outer(norms[one], norms[two]) * (1 - 1e-9)
        i, j = np.nonzero(close)
        i, j = one[i], two[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        cosine = np.einsum("ij,ij->i", vectors[i], vectors[j]) / (norms[i] * norms[j])
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        signatures = np.stack(list(group["sig"]))
        met = (signatures[i, :table] == signatures[j, :table]).any(axis=1)
        i, j = i[~met], j[~met]
        weight = group["weight"].to_numpy()
        links = np.zeros(len(group), np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        rep = group["rep"].to_numpy()
        order = np.argsort(rep, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        peer = rep[order][local_components(len(group), place[i], place[j])[place]]
        used = links > 0
        return pd.DataFrame({"rep": rep[used], "links": links[used], "peer": peer[used]})

    return compare


def near_duplicate_vectors(
    vectors: DataFrame,
    row_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    recall: float = 0.999,
    seed: int = 7,
) -> DataFrame:
    """``(row_id, n_links, component_id, kept)`` for each row of ``vectors``.

    Equal vectors are one class with a weight, so copies are never compared.
    Classes meet in the buckets of their sign hashes; a bucket of over 2,048
    classes is dealt into blocks and every pair of blocks is one task. All
    pairs of a bucket are verified by exact cosine, and a pair counts in the
    first table it meets in, so no pair is ever listed: a task returns link
    counts and a spanning forest, at most one row per vector it read.

    Rows with a null id, or with a vector that is null, empty, zero or holds
    null or non-finite values, link with nothing and are kept; their component
    is their own id. Vectors of different length do not link. A repeated row
    counts as another vector. Other columns of the input are ignored.
    """
    rows = vectors.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("vec", F.when(sound, F.col("vec")))
    classes, _ = keep(
        rows.where("vec is not null").groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "vectors"
    )
    bits, tables = table_plan(classes.count(), threshold, recall)
    signed = classes.mapInPandas(
        _signer(bits, tables, seed), "vec array<double>, rep bigint, weight bigint, sig array<bigint>, dim int"
    )
    placed = signed.select("*", F.posexplode("sig").alias("table", "bucket"))
    place = ["table", "dim", "bucket"]
    large = placed.groupBy(*place).count().where(F.col("count") > BLOCK)
    dealt = (
        placed.join(large, place, "left")
        .withColumn("blocks", F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select(*place, "low", "high", "block", "rep", "weight", "vec", "sig")
    )
    found, _ = keep(
        dealt.groupBy(*place, "low", "high").applyInPandas(_comparer(threshold), "rep bigint, links bigint, peer bigint"), "found"
    )
    components = connected_components(found, "rep", "peer")
    known = (
        classes.join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        .join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "vec",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return rows.join(known, "vec", "left").select(
        F.col("id").alias(row_id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").cast("bigint").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
