"""Exact top-k by inner product from an impact-ordered index, score at a time.

Each block of rows is an index of its own: for every dimension the rows are
filed by quantised value into posting segments. For a query the segments of all
dimensions are taken by descending impact, the most a segment can add above the
least value of its dimension. After each round the rows that could still be
among the k best are counted; the search of a block ends only on the proof that
nothing else can, and those rows are then scored exactly with integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_IN_BLOCK = 8192
QUERIES_IN_BLOCK = 512
LEVELS = 16
ROUNDS = 8


class ImpactIndex:
    """Posting segments of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: int = LEVELS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.exact = self.rows.astype(np.float64)
        self.low, self.high, self.starts, self.postings = [], [], [], []
        for values in self.rows.T:
            by_value = np.argsort(values, kind="stable")
            cuts = np.unique(np.linspace(0, len(values), min(levels, len(values)) + 1).astype(np.int64))
            self.postings.append(by_value)
            self.starts.append(cuts)
            self.low.append(values[by_value[cuts[:-1]]])
            self.high.append(values[by_value[cuts[1:] - 1]])

    def search(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows, without the row ``own``."""
        wanted = np.flatnonzero(self.ids != own) if own is not None else np.arange(len(self.ids))
        if len(wanted) > 4 * k and query.any():
            wanted = wanted[self._possible(query, k, wanted)]
        scores = self.rows[wanted] @ query
        best = np.lexsort((self.ids[wanted], -scores))[:k]
        return self.ids[wanted[best]], scores[best]

    def _possible(self, query: np.ndarray, k: int, wanted: np.ndarray) -> np.ndarray:
        dims = np.flatnonzero(query)
        # Per segment: the least and the most that it adds to the least value of its dimension.
        dim, number, least, most, size = [], [], [], [], []
        for d in dims:
            q = int(query[d])
            low, high = (self.low[d] * q, self.high[d] * q) if q > 0 else (self.high[d] * q, self.low[d] * q)
            floor = low.min()
            dim.append(np.full(len(low), d))
            number.append(np.arange(len(low)))
            least.append(low - floor)
            most.append(high - floor)
            size.append(np.diff(self.starts[d]))
        dim, number, least, most, size = map(np.concatenate, (dim, number, least, most, size))
        order = np.argsort(-most, kind="stable")
        lower = np.zeros(len(self.ids), np.int64)
        # What a row could still gain at most: the impact of the next segment of each dimension not met yet.
        upper = np.zeros(len(self.ids), np.int64)
        ahead = {int(d): int(most[dim == d].max()) for d in dims}
        rest = sum(ahead.values())
        by_dim = {int(d): list(order[dim[order] == d]) for d in dims}
        done = 0
        for part in np.array_split(order, ROUNDS):
            for s in part:
                d = int(dim[s])
                rows = self.postings[d][self.starts[d][number[s]] : self.starts[d][number[s] + 1]]
                lower[rows] += least[s]
                upper[rows] += most[s]
                by_dim[d].pop(0)
                rest -= ahead[d]
                ahead[d] = int(most[by_dim[d][0]]) if by_dim[d] else 0
                rest += ahead[d]
            done += len(part)
            bar = np.partition(lower[wanted], len(wanted) - k)[len(wanted) - k]
            possible = np.flatnonzero(upper[wanted] + rest >= bar)
            if len(possible) <= max(4 * k, len(wanted) // 64):
                break
        return possible


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``v`` = floor(scale * x); rows with null or non-finite parts go."""
    x = F.col("x")
    unusable = F.exists("x", lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    return (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
        .where(F.col("id").isNotNull() & x.isNotNull())
        .where(~unusable)
        .select("id", F.transform("x", lambda y: F.floor(y * scale).cast("long")).alias("v"))
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(
    df: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    levels: int = LEVELS,
    rows_in_block: int = ROWS_IN_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the highest products.

    A query's own id is no candidate. Ties go to the smaller id; a repeated id
    is as many rows. With fewer candidates all are returned, with none the
    query has no row. Vectors that are null or hold null or non-finite parts
    take no part; shorter vectors count as filled with zeros. Products must fit
    into 64 bits.

    Rows and queries are dealt into blocks and every block of rows meets every
    block of queries once, as the search over all rows asks for; a task holds
    one block of each and returns k rows per query.
    """
    rows, asked = integer_vectors(df, id_col, vector_col, scale), integer_vectors(queries, id_col, vector_col, scale)
    n, m = (x.count() for x in (rows, asked))
    row_blocks, query_blocks = max(1, -(-n // rows_in_block)), max(1, -(-m // QUERIES_IN_BLOCK))

    def dealt(frame: DataFrame, blocks: int, name: str, others: int, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return frame.select("id", "v", own.alias(name)).select("*", every.alias(other))

    left = dealt(rows, row_blocks, "r", query_blocks, "q")
    right = dealt(asked, query_blocks, "q", row_blocks, "r")

    def search(block: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(wanted):
            width = max(block["v"].map(len).max(), wanted["v"].map(len).max(), 1)
            index = ImpactIndex(block["id"].to_numpy(), _matrix(block["v"], width), levels)
            for own, query in zip(wanted["id"], _matrix(wanted["v"], width), strict=True):
                ids, scores = index.search(query, k, own)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})

    best = (
        left.groupBy("q", "r")
        .cogroup(right.groupBy("q", "r"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
