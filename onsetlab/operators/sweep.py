"""How many intervals cover a day, without pairing days with intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from onsetlab.functions.dates import day_number


def covering_weight(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    lo: str,
    hi: str,
    weights: Sequence[str],
) -> DataFrame:
    """Add to each point the summed weights of its key's intervals that cover it.

    ``points`` has ``key`` and the date ``at``; ``intervals`` has ``key``, the
    dates ``lo`` and ``hi`` (both inclusive) and the integer ``weights``. The
    result is ``points`` with one bigint column per weight, 0 where no interval
    covers the point.

    An interval join would test every pair within a key, which is quadratic for
    a key with many rows. Here an interval becomes a step up at its first day
    and a step down after its last, steps of the same day are summed before
    they are shuffled, and a running total over the key's days gives the cover:
    one shuffle on ``key`` and work linear in the rows, where a key has at most
    one step row per calendar day.
    """
    first, after = day_number(lo), day_number(hi) + 1
    up = F.struct(first.alias("_day"), *[F.col(w).cast("bigint").alias(w) for w in weights])
    down = F.struct(after.alias("_day"), *[(-F.col(w).cast("bigint")).alias(w) for w in weights])
    steps = (
        intervals.filter(F.col(key).isNotNull() & (F.col(lo) <= F.col(hi)))
        .select(key, F.inline(F.array(up, down)))
        .groupBy(key, "_day")
        .agg(*[F.sum(w).alias(w) for w in weights])
    )
    marked = points.select(
        "*",
        day_number(at).alias("_day"),
        *[F.lit(0).cast("bigint").alias(w) for w in weights],
        F.lit(True).alias("_point"),
    )
    until_day = (
        Window.partitionBy(key)
        .orderBy("_day")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    covered = marked.unionByName(steps, allowMissingColumns=True).select(
        *points.columns,
        "_point",
        *[F.coalesce(F.sum(w).over(until_day), F.lit(0)).alias(w) for w in weights],
    )
    return covered.filter("_point").drop("_point")
