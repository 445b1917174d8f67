"""Exact ranks and rank cuts without a window over the whole table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.hashing import hash_key
from tallyloom.session import cut_lineage

# The first four hex digits of a hash: never more than 65,536 blocks, so every
# table with one row per block has a fixed size bound.
BLOCK_DIGITS = 4
BEFORE = (Window.unboundedPreceding, -1)
ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def _hashed(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    return df.withColumn("_h", hash_key(row_id, seed)).withColumn("_block", F.substring("_h", 1, BLOCK_DIGITS))


def _block_offsets(blocks: DataFrame) -> DataFrame:
    """Exclusive prefix sum ``_before`` and grand total ``_all`` per block (at most 65,536 rows)."""
    order = Window.orderBy("_block")
    return blocks.select(
        "_block",
        "_sum",
        F.coalesce(F.sum("_sum").over(order.rowsBetween(*BEFORE)), F.lit(0)).cast("bigint").alias("_before"),
        F.sum("_sum").over(order.rowsBetween(*ALL)).cast("bigint").alias("_all"),
    )


def shuffled_rank(df: DataFrame, row_id: str, seed: int, out: str = "rk", total: str | None = None) -> DataFrame:
    """Zero-based position of each row in the seeded permutation of unique ``row_id``.

    Rows are ranked inside hash blocks and shifted by the sizes of the earlier
    blocks, so no task sees more than one block.
    """
    hashed = _hashed(df, row_id, seed)
    offsets = _block_offsets(hashed.groupBy("_block").agg(F.count("*").alias("_sum")))
    inside = Window.partitionBy("_block").orderBy("_h", row_id)
    ranked = hashed.join(F.broadcast(offsets), "_block").withColumn(
        out, (F.row_number().over(inside) - 1 + F.col("_before")).cast("bigint")
    )
    if total:
        ranked = ranked.withColumn(total, F.col("_all"))
    return ranked.drop("_h", "_block", "_sum", "_before", "_all")


def prefix_sum(df: DataFrame, rank: str, rows: str, value: str, out: str = "lo", total: str = "all_sum") -> DataFrame:
    """Exclusive running sum of an integer column in the order of a zero-based rank.

    ``rows`` is a column holding the row count. Ranks are cut into at most
    65,536 blocks of equal length.
    """
    blocks = 16**BLOCK_DIGITS
    cut = df.withColumn("_block", F.floor(F.col(rank) / F.ceil(F.col(rows) / F.lit(blocks))))
    offsets = _block_offsets(cut.groupBy("_block").agg(F.sum(value).alias("_sum")))
    inside = Window.partitionBy("_block").orderBy(rank).rowsBetween(*BEFORE)
    return (
        cut.join(F.broadcast(offsets), "_block")
        .withColumn(out, (F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_before")).cast("bigint"))
        .withColumn(total, F.col("_all"))
        .drop("_block", "_sum", "_before", "_all")
    )


def permutation_part(
    df: DataFrame,
    row_id: str,
    seed: int,
    cuts: Callable[[Column], Sequence[Column]],
    out: str = "part",
    population: DataFrame | None = None,
) -> DataFrame:
    """Number of cut positions at or before each row of the seeded permutation.

    The permutation is that of ``population``, by default ``df`` itself.

    ``cuts`` maps the row count to zero-based positions. Only the keys standing
    at the cuts are looked up, by one job over the ids with one result row per
    cut; each row is then compared with these few keys, so the rows themselves
    are never shuffled or sorted.
    """
    hashed = _hashed((df if population is None else population).select(row_id), row_id, seed)
    blocks = _block_offsets(hashed.groupBy("_block").agg(F.count("*").alias("_sum")))
    wanted = (
        blocks.withColumn("_cut", F.explode(F.array(*[c.cast("bigint") for c in cuts(F.col("_all"))])))
        .where((F.col("_cut") >= F.col("_before")) & (F.col("_cut") < F.col("_before") + F.col("_sum")))
        .select("_block", (F.col("_cut") - F.col("_before")).alias("_at"))
    )
    per_block = wanted.groupBy("_block").agg(F.collect_list("_at").alias("_ats"))
    inside = Window.partitionBy("_block").orderBy("_h", row_id)
    at_cuts = (
        hashed.join(F.broadcast(per_block), "_block")
        .withColumn("_pos", (F.row_number().over(inside) - 1).cast("bigint"))
        .withColumn("_at", F.explode("_ats"))
        .where(F.col("_pos") == F.col("_at"))
        .select("_h", row_id)
    )
    key = F.struct(hash_key(row_id, seed), F.col(row_id))
    kind = df.schema[row_id].dataType
    passed = [(key >= F.struct(F.lit(h), F.lit(i).cast(kind))).cast("int") for h, i in at_cuts.collect()]
    return df.withColumn(out, reduce(add, passed, F.lit(0)))


def _in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` sorted and stored in ranges of about equal length: their number ``_p`` and the place ``_i`` inside."""
    ordered = cut_lineage(df.orderBy(*order)).withColumn("_m", F.monotonically_increasing_id())
    return ordered.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m")


def last_known(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """The value of the last row at or before each one that has a value; null before the first. Ties follow no rule.

    Rows are sorted into ranges; a window stays inside a range, and one value
    per range is carried on to the later ones.
    """
    ranges = _in_ranges(df, *order)
    ends = ranges.where(F.col(value).isNotNull()).groupBy("_p").agg(F.max_by(value, "_i").alias("_end"))
    # One row per range, also for ranges without a value.
    ends = ranges.select("_p").distinct().join(F.broadcast(ends), "_p", "left")
    carry = ends.select("_p", F.last("_end", ignorenulls=True).over(Window.orderBy("_p").rowsBetween(*BEFORE)).alias("_carry"))
    inside = Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    filled = ranges.withColumn("_own", F.last(value, ignorenulls=True).over(inside)).join(F.broadcast(carry), "_p")
    return filled.withColumn(out, F.coalesce("_own", "_carry")).drop("_p", "_i", "_own", "_carry")


def ordered_index(df: DataFrame, *order: Column | str, out: str = "idx", start: int = 0) -> DataFrame:
    """Consecutive numbers in the given order, which must have no ties.

    A range-partitioned sort is written to the checkpoint folder; numbering
    needs only the sizes of its partitions.
    """
    ordered = _in_ranges(df, *order)
    window = Window.orderBy("_p").rowsBetween(*BEFORE)
    offsets = (
        ordered.groupBy("_p")
        .agg(F.count("*").alias("_n"))
        .select("_p", F.coalesce(F.sum("_n").over(window), F.lit(0)).alias("_before"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_p")
        .withColumn(out, (F.col("_before") + F.col("_i") + start).cast("bigint"))
        .drop("_p", "_i", "_before")
    )
