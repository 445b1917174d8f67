"""Repeatable randomness: every draw is a hash of an id and a seed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column | str | int) -> Column:
    """32 hex digits of the md5 of the parts joined by ``:``.

    String arguments name columns, integers are literals.
    """
    cols = [F.lit(str(p)) if isinstance(p, int) else F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]).cast("binary"))


def hash_number(*parts: Column | str | int) -> Column:
    """Uniform integer in ``[0, 2**60)``: the first 15 hex digits of the key."""
    return F.conv(F.substring(hash_key(*parts), 1, 15), 16, 10).cast("bigint")
