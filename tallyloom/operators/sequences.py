"""Token sequences: vocabulary ids, truncation, batches with padding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.ranking import ordered_index
from tallyloom.operators.skew import Size, lookup_join, measure
from tallyloom.session import materialize

# Reserved ids, sequence length.
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_ID = 2
MAX_LENGTH = 256


@dataclass(frozen=True)
class TokenIds:
    """``(token, n, token_id)`` ordered by falling frequency, then token."""

    table: DataFrame
    size: Size


def build_ids(tokens: DataFrame) -> TokenIds:
    """Ids of all tokens in a column ``token``."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"))
    table = materialize(ordered_index(counts, F.desc("n"), "token", out="token_id", start=FIRST_ID), "token-ids")
    return TokenIds(table, measure(table, "token"))


def encode(positions: DataFrame, ids: TokenIds, row_id: str, **limits) -> DataFrame:
    """``(row_id, pos, token_id)`` from ``(row_id, pos, token)``; unknown tokens share one id."""
    joined = lookup_join(positions, ids.table, "token", row_id, "n", size=ids.size, **limits)
    return joined.select(row_id, "pos", F.coalesce("token_id", F.lit(UNKNOWN_ID)).alias("token_id"))


def as_arrays(encoded: DataFrame, row_id: str) -> DataFrame:
    """``(row_id, input_ids)``, one array per text."""
    lists = encoded.groupBy(row_id).agg(F.sort_array(F.collect_list(F.struct("pos", "token_id"))).alias("_p"))
    return lists.select(row_id, F.transform("_p", lambda s: s["token_id"].cast("int")).alias("input_ids"))


def truncated(tokens: Column, length: int = MAX_LENGTH) -> Column:
    return F.slice(tokens, 1, length)


def batch_number(row_number: Column, batch_size: int) -> Column:
    """Batch of a row numbered from one."""
    return F.floor((row_number - 1) / batch_size)


def padded(df: DataFrame, ids: str, batch: str) -> DataFrame:
    """Pad ``ids`` to the longest row of its batch and add the mask of real entries.

    The window holds one batch.
    """
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    missing = F.col("_longest") - F.size(ids)
    return df.withColumn("_longest", longest).withColumns(
        {
            ids: F.concat(ids, F.array_repeat(F.lit(PAD_ID), missing)),
            "attention_mask": F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing)),
        }
    ).drop("_longest")
