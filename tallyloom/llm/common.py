"""Storage, text buffers and connected components shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch

# Bytes of text that numpy works on at once, unless one text is longer.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared folder; the table read back, and its path."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables of :func:`keep` that no later plan reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """UTF-8 bytes of a string column in runs of whole texts.

    Yields ``(first row, last row + 1, bytes, offsets)``; the offsets of the
    run's texts start at 0. A null is an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    rows = len(column)
    if not rows:
        return
    bounds = np.frombuffer(ends, np.int64)[column.offset : column.offset + rows + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, whole[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        out = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        out = (out ^ (out >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return out ^ (out >> np.uint64(33))


def local_components(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``size`` positions by the given links."""
    label = np.arange(size)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x or 0


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(id, component)`` of linked ids; a component is named by its smallest id.

    That id itself has no row, nor has an id without links.

    Alternates two star steps: each node hands its larger neighbours, then its
    smaller ones, to the smallest neighbour it knows. Neighbourhoods are only
    ever reduced to a minimum, never gathered, and the links of a hub are
    joined by shuffles that adaptive execution can split. Every round is
    written to the shared folder; the driver sees a count and a checksum.
    """
    spark = edges.sparkSession
    start = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    )
    links, path = keep(start.distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(smallest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        following, new_path = keep(pairs.select("e.u", "e.v").where("u <> v").distinct(), "links")
        old, state = state, _state(following)
        drop(spark, path)
        links, path = following, new_path
        if state == old:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("component"))
