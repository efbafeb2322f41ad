"""Compact rows that stand for several equal rows, and the rows they stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16


def expand_rows(
    df: DataFrame,
    count_col: str,
    spread: Sequence[str] | None = None,
    most: int | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Repeat each row ``count_col`` times and drop that column.

    A row that stands for more than ``CHUNK`` is first cut into chunks, and the
    chunks are shuffled while they are still compact, so no task has to write out
    all copies of one row. ``spread`` names the columns that tell rows apart,
    where that takes fewer than all.

    Rows are repeated where they are if no count is above ``CHUNK``, as ``most``
    may say. Say ``shuffled`` if ``df`` ends in a shuffle or reads staged rows:
    then it is used twice, and only the rows with larger counts are shuffled.
    """
    kept = [c for c in df.columns if c != count_col]
    n = F.col(count_col)

    def copied(rows: DataFrame, count: Column) -> DataFrame:
        every = F.explode(F.sequence(F.lit(1), count.cast("int")))
        return rows.select(*kept, every.alias("_copy")).drop("_copy")

    def chunked(rows: DataFrame) -> DataFrame:
        last_chunk = F.floor((n - 1) / CHUNK)
        chunks = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
        copies = F.least(F.lit(CHUNK), n - F.col("_chunk") * CHUNK).alias("_copies")
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spreading = chunks.select(*kept, "_chunk", copies).repartition(partitions, *(spread or kept), "_chunk")
        return copied(spreading, F.col("_copies"))

    if most is not None and most <= CHUNK:
        return copied(df.filter(n > 0), n)
    if shuffled:
        return copied(df.filter((n > 0) & (n <= CHUNK)), n).unionByName(chunked(df.filter(n > CHUNK)))
    return chunked(df.filter(n > 0))
