"""Lookup of a per-key table when some keys are very frequent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table estimated at up to this many bytes is broadcast.
BROADCAST_BYTES = 64 << 20
# Bytes counted per value beside the key itself.
VALUE_BYTES = 16
# A key is hot when it holds more than 1/HOT_SHARE of all weight, so there are
# always fewer than HOT_SHARE hot keys.
HOT_SHARE = 2_000


@dataclass(frozen=True)
class Size:
    """Counted rows and key bytes of a lookup table with a string key."""

    rows: int
    key_bytes: int

    def fits(self, columns: int, limit: int = BROADCAST_BYTES) -> bool:
        return self.key_bytes + self.rows * columns * VALUE_BYTES <= limit


def measure(table: DataFrame, key: str) -> Size:
    row = table.agg(F.count("*").alias("rows"), F.sum(F.octet_length(key)).alias("bytes")).first()
    return Size(row.rows, row.bytes or 0)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread: str,
    weight: str,
    how: str = "left",
    size: Size | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` with a table holding one row per ``key``.

    A table whose measured ``size`` fits the limit is sent to every task and
    ``facts`` is not shuffled. A larger table is joined by shuffle; keys whose
    ``weight`` in the table shows them to be hot are dealt over several
    partitions by a hash of ``spread``, with their few table rows repeated.
    """
    if size is None:
        size = measure(table, key)
    if size.fits(len(table.columns), limit):
        return facts.join(F.broadcast(table), key, how)
    total = table.agg(F.sum(weight)).scalar()
    hot = table.where(F.col(weight) * HOT_SHARE > total).select(
        key, F.ceil(F.col(weight) * HOT_SHARE / total).cast("int").alias("_fan")
    )
    salted_facts = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_fan", F.lit(1))).cast("int"))
        .drop("_fan")
    )
    salted_table = (
        table.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1)))
        .drop("_fan")
    )
    return salted_facts.join(salted_table, [key, "_salt"], how).drop("_salt")
