"""Places of rows in a distributed sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep


def positions(df: DataFrame, *order: str) -> tuple[DataFrame, str]:
    """``df`` with its zero-based place ``idx`` in the given order, and the path of the table behind it.

    The range-partitioned sort is written once; places need only the sizes of
    its partitions, a table of one row per partition.
    """
    sorted_rows = df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id())
    stored, path = keep(sorted_rows, "sorted")
    stored = stored.withColumn("_p", F.shiftright("_m", 33))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = stored.join(F.broadcast(starts), "_p")
    idx = (F.col("_start") + F.col("_m").bitwiseAND((1 << 33) - 1)).cast("bigint")
    return placed.withColumn("idx", idx).drop("_m", "_p", "_start"), path
