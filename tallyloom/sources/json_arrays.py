"""Files that hold one JSON array of objects, read and written in several tasks.

A file is read by Spark's text source in splits of bytes, cut after every closing
brace, wherever it stands. Whether such a brace ends an element depends on all
text before it, but only through two running sums: the quotes, which tell if it
stands inside a string, and the depth of braces outside strings. Both are sums
inside a split plus those of the earlier splits, so no task sees a whole file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.session import materialize

SPLIT = ("_file", "_block")


class BrokenArray(ValueError):
    """A file ends inside a string or an object, or closes more objects than it opens."""


def _running(df: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over all earlier pieces of the same file."""
    sums = df.groupBy(*SPLIT).agg(F.sum(value).alias("_sum"))
    # One row per split of a file.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*SPLIT, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*SPLIT).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    # Both sides are distributed by split already.
    return df.withColumn(out, own).join(starts, list(SPLIT)).withColumn(out, F.col(out) + F.col("_start")).drop("_start")


def _opened(inside: Column) -> Column:
    """Opening braces outside strings of a piece that may begin inside a string; escapes are gone already."""
    text = F.concat(F.when(inside, '"').otherwise(""), F.col("_bare"))
    outside = F.regexp_replace(text, '"[^"]*("|$)', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit("{")))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``(file, element, json)``: the objects of every array file below ``path``, numbered from 0 in each file, in this order.

    Objects may be nested and strings may hold any character. Empty arrays and
    empty files have no elements. A file that ends too early raises
    :class:`BrokenArray`. One element has to fit in a task, a file need not.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_i"),
    )
    # An escape never spans two pieces: a brace is not a character that can be escaped.
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = materialize(pieces.withColumn("_quotes", F.length(bare) - F.length(F.replace(bare, F.lit('"')))), "array-pieces")
    known = _running(pieces, "_quotes", "_before").withColumn("_bare", bare)
    ends_outside = (F.col("_before") + F.col("_quotes")) % 2 == 0
    known = known.withColumn("_open", _opened(F.col("_before") % 2 == 1)).withColumn("_close", ends_outside.cast("int"))
    known = materialize(known.withColumn("_step", F.col("_open") - F.col("_close")).drop("_bare", "_before"), "array-depths")
    depths = _running(known, "_step", "_above")
    ends = (F.col("_close") == 1) & (F.col("_above") + F.col("_step") == 0)
    marked = materialize(depths.withColumn("_ends", ends.cast("int")), "array-marks")
    # The text behind the last brace is the only piece that no brace follows; it has to close the array.
    last = F.struct(*SPLIT[1:], "_i")
    tails = marked.groupBy("_file").agg(
        F.max_by(F.struct("value", "_above", "_open", "_close"), last).alias("t"), F.min(F.when(F.col("_open") > 0, F.col("_above"))).alias("low")
    )
    closed = F.regexp_replace("t.value", r"\s+", "").isin("]", "[]", "") & (F.col("t._above") == 0) & (F.col("t._close") == 1)
    broken = tails.where(~closed | (F.col("low") < 0)).select("_file").first()
    if broken is not None:
        raise BrokenArray(broken["_file"])
    numbered = _running(marked, "_ends", "element").where((F.col("_above") > 0) | (F.col("_open") > 0))
    # Ranges of elements serve the grouping and keep the order of the array; there is no second shuffle.
    ranges = numbered.repartitionByRange("_file", "element").groupBy("_file", "element")
    joined = ranges.agg(F.sort_array(F.collect_list(F.struct("_block", "_i", "value"))).alias("p")).sortWithinPartitions("_file", "element")
    text = F.concat(F.array_join(F.transform("p", lambda p: p["value"]), "}"), F.lit("}"))
    return joined.select(F.col("_file").alias("file"), "element", F.regexp_replace(text, r"^[\s,\[]+", "").alias("json"))


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The objects of the array files below ``path``; fields that are missing or of another kind are null."""
    return array_elements(spark, path).select(F.from_json("json", schema).alias("_e")).select("_e.*")


def _as_array(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    start = "["
    for frame in frames:
        for line in frame["value"]:
            yield pd.DataFrame({"value": [start + line]})
            start = ","
    yield pd.DataFrame({"value": ["[]" if start == "[" else "]"]})


def write_json_array(df: DataFrame, path: str) -> None:
    """A folder of files, each of them one JSON array of the rows of a partition."""
    lines = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    lines.mapInPandas(_as_array, "value string").write.text(path)
