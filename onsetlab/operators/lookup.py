"""Joins of large tables to lookup tables whose size is measured first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlab.functions.sizes import ROW_OVERHEAD_BYTES, table_bytes
from onsetlab.sources.staging import Stages, measured, session_stages

__all__ = ["BROADCAST_BYTES", "ROW_OVERHEAD_BYTES", "fits_broadcast", "lookup_join", "prefilter_keys"]

BROADCAST_BYTES = 64 << 20
SALTS = 32
#: A key with more than this part of the rows is hot.
HOT_SHARE = 128
#: Keys that a summary tracks. It errs by a few rows in so many, far below a hot key's part.
TRACKED_KEYS = 1 << 14


def fits_broadcast(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a table and tell whether it may be copied to every executor.

    A staged table was measured when it was written. For another one this runs
    an aggregate over it, so give one that is cheap to compute.
    """
    known = measured(table)
    size = known["bytes"] if known else table.agg(table_bytes(table).alias("bytes")).first()["bytes"]
    return size <= max_bytes


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    how: str,
    spread: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
    at_most: DataFrame | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Join ``rows`` to a lookup table on one key (inner, left or left_semi).

    Up to ``max_bytes`` the table is broadcast and ``rows`` is not shuffled.
    Beyond that ``rows`` is staged, in ``stages`` or in those of the session,
    and what computes it runs once. A summary of its frequent keys is taken while
    it is written. Both sides are then shuffled on the key, the table cut down to
    the keys that occur; a key that holds a large part of ``rows`` is divided
    between tasks by a salt taken from the ``spread`` columns, and its entries
    alone are repeated once per salt. ``at_most`` is a frame that is no smaller
    than the table and cheaper to measure, or measured already.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    if _may_copy(table, at_most, max_bytes):
        return rows.join(F.broadcast(table), on, how)
    rows = (stages or session_stages(rows.sparkSession)).stage(rows, "rows", _frequent(on).alias("frequent"))
    occurring = rows.where(F.col(on).isNotNull()).select(on).distinct()
    table = table.join(occurring.hint("merge"), on, "left_semi")
    hot = F.col(on).isin(_hot_keys(measured(rows)))
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS).cast("bigint")).cast("int")
    every_salt = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return (
        rows.withColumn("_salt", F.when(hot, salt).otherwise(0))
        .join(table.withColumn("_salt", every_salt), [on, "_salt"], how)
        .drop("_salt")
    )


def _may_copy(table: DataFrame, at_most: DataFrame | None, max_bytes: int) -> bool:
    if at_most is not None and fits_broadcast(at_most, max_bytes):
        return True
    # What was measured for nothing costs no second look at the table itself.
    return (at_most is None or measured(at_most) is not None) and fits_broadcast(table, max_bytes)


def _frequent(on: str) -> Column:
    """The most frequent keys with their counts: a sketch that is merged across tasks."""
    return F.expr(f"approx_top_k(`{on}`, {2 * HOT_SHARE}, {TRACKED_KEYS})")


def _hot_keys(summary: dict) -> list:
    """The keys with more than one in HOT_SHARE rows: fewer than 2 * HOT_SHARE keys."""
    frequent = summary["frequent"] or []
    return [k["item"] for k in frequent if k["item"] is not None and k["count"] * HOT_SHARE > summary["rows"]]


def prefilter_keys(
    rows: DataFrame, keys: DataFrame, on: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Drop rows whose key is not in ``keys``, where that costs no shuffle.

    This only saves later work: when ``keys`` is too large to broadcast the
    rows come back as they are, and the caller's own join drops the others.
    """
    if fits_broadcast(keys, max_bytes):
        return rows.join(F.broadcast(keys), on, "left_semi")
    return rows
