"""A bucket number that depends on a key's value and on nothing else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def key_bucket(column: Column | str) -> Column:
    """0..9999 from the first 32 bits of the md5 of the key's text.

    The same key lands in the same bucket however the rows are partitioned, and
    any engine with md5 computes the same number.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(BUCKETS))
