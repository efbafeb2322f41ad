"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

Rows are put in the order of a Hilbert curve through their vectors and written
as Parquet rows of one block each, with the least and greatest value of every
dimension beside it. By interval arithmetic these bound the product of any
vector with any row of the block. A question asks for the first rows whose
product lies in a window; it goes only to shelves (neighbouring blocks) with a
block whose bounds meet the window, and there only to such blocks, and no more
once its first rows are known to be better than what a block can hold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onsetlab.llm.scratch import cut
from onsetlab.sources.staging import session_stages

#: Rows in a block, and blocks in a shelf.
BLOCK_ROWS, SHELF_BLOCKS = 256, 16
#: Questions, and zone maps, that meet in one task.
GROUP_ASKS, CHUNK_BLOCKS = 4096, 4096
#: Questions answered side by side.
SLICE_ASKS = 256
#: Bits of the curve for each dimension.
CURVE_BITS = 4
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_LONG, _BINARY = pa.int64(), pa.binary()


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve, as bytes that sort like them; ``cells`` is (rows, dimensions)."""
    x = cells.astype(np.uint32).T.copy()
    top = 1 << (bits - 1)
    # Undo the rotations and reflections, from the coarsest cells to the finest.
    q = top
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(len(x)):
            in_half = (x[i] & np.uint32(q)) != 0
            swap = np.where(in_half, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(in_half, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & np.uint32(q)) != 0, q - 1, 0).astype(np.uint32)
        q >>= 1
    x ^= turn
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    spread = (x[None, :, :] >> shifts[:, None, None]) & np.uint32(1)
    return np.packbits(spread.transpose(2, 0, 1).reshape(x.shape[1], -1).astype(np.uint8), axis=1)


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each vector with any row of each block: (vectors, blocks)."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _as_rows(column: pa.ChunkedArray | pa.Array, dtype: np.dtype, width: int) -> np.ndarray:
    """Packed vectors, one or more in each value, below one another."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


class _Shape:
    """What all tasks know of the vectors: their width and the greatest absolute value."""

    def __init__(self, width: int, largest: int):
        self.width, self.largest = width, largest
        fits = [d for d in (np.int16, np.int32, np.int64) if largest <= np.iinfo(d).max]
        self.stored = np.dtype(fits[0])
        # Products of doubles are exact below 2**53, and much faster.
        exact = width * largest * largest < 1 << 53
        self.worked = np.dtype(np.float64 if exact else np.int64)


def _blocks(rows: DataFrame, shape: _Shape) -> DataFrame:
    """The rows (id, label, anchor, v) as blocks in the curve's order."""
    spark = rows.sparkSession
    width, stored = shape.width, shape.stored
    step = max(1, -(-(2 * shape.largest + 1) // (1 << CURVE_BITS)))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.zeros((batch.num_rows, width), np.int64)
            values = batch.column(3)
            sizes = np.diff(np.asarray(values.offsets))
            at = np.arange(len(values.flatten())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            vectors[np.repeat(np.arange(len(sizes)), sizes), at] = np.asarray(values.flatten())
            keys = hilbert_keys((vectors + shape.largest) // step, CURVE_BITS)
            packed = vectors.astype(stored)
            columns = [pa.array([r.tobytes() for r in m], _BINARY) for m in (keys, packed)]
            yield pa.RecordBatch.from_arrays([columns[0], *batch.columns[:3], columns[1]], ["key", "id", "label", "anchor", "vector"])

    placed = rows.select("id", "label", "anchor", "v").mapInArrow(
        place, "key binary, id long, label long, anchor boolean, vector binary"
    )
    # Rows of one place are told apart by id, so that very many equal vectors are many blocks.
    by_place = ["key", "id", "label", "vector"]
    ordered = placed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by_place)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            while held.num_rows >= BLOCK_ROWS:
                yield _block(held.slice(0, BLOCK_ROWS), part, number, shape)
                held, number = held.slice(BLOCK_ROWS), number + 1
        if held is not None and held.num_rows:
            yield _block(held, part, number, shape)

    return ordered.sortWithinPartitions(*by_place).mapInArrow(
        pack,
        "shelf long, block long, rows long, ids binary, labels binary, anchors binary, vectors binary,"
        " low binary, high binary, held binary",
    )


def _block(rows: pa.Table, part: int, number: int, shape: _Shape) -> pa.RecordBatch:
    block = part << 24 | number
    labels = rows.column("label").to_numpy()
    vectors = _as_rows(rows.column("vector"), shape.stored, shape.width)
    packed = [
        rows.column("id").to_numpy(),
        labels,
        rows.column("anchor").to_numpy(zero_copy_only=False).astype(np.uint8),
        vectors,
        vectors.min(axis=0),
        vectors.max(axis=0),
        np.unique(labels),
    ]
    numbers = [pa.array([n], _LONG) for n in (block // SHELF_BLOCKS, block, rows.num_rows)]
    names = ["shelf", "block", "rows", "ids", "labels", "anchors", "vectors", "low", "high", "held"]
    return pa.RecordBatch.from_arrays([*numbers, *(pa.array([p.tobytes()], _BINARY) for p in packed)], names)


ASK = "ask long, id long, label long, vector binary, low binary, high binary"


def _anchors(blocks: DataFrame, shape: _Shape, positives: int) -> DataFrame:
    """Each anchor with a window from the product of its best rows in its own block upward."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, labels, anchors, vectors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.flatnonzero(np.frombuffer(anchors, np.uint8))
                if not len(at):
                    continue
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                own = np.frombuffer(vectors, shape.stored).reshape(len(ids), -1)
                low = np.full(len(at), LEAST)
                scores = (own.astype(shape.worked) @ own[at].T.astype(shape.worked)).astype(np.int64)
                wanted = (labels[:, None] == labels[at]) & (ids[:, None] != ids[at])
                if len(ids) >= positives:
                    low = np.partition(np.where(wanted, scores, LEAST), -positives, axis=0)[-positives]
                columns = [
                    pa.array(block * BLOCK_ROWS + at, _LONG),
                    pa.array(ids[at], _LONG),
                    pa.array(labels[at], _LONG),
                    *(pa.array([r.tobytes() for r in m], _BINARY) for m in (own[at], low, np.full(len(at), MOST))),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ASK.split(", ")])

    return blocks.select("block", "ids", "labels", "anchors", "vectors").mapInArrow(find, ASK)


class _Asks:
    """Questions as arrays."""

    def __init__(self, table: pa.Table, shape: _Shape):
        self.ask, self.id, self.label = (table.column(c).to_numpy() for c in ("ask", "id", "label"))
        self.vectors = _as_rows(table.column("vector"), shape.stored, shape.width).astype(shape.worked)
        low, high = (table.column(c).to_pylist() for c in ("low", "high"))
        windows = max((len(v) // 8 for v in low), default=0)
        self.low = np.full((len(self.ask), windows), MOST)
        self.high = np.full((len(self.ask), windows), LEAST)
        for i, (a, b) in enumerate(zip(low, high, strict=True)):
            self.low[i, : len(a) // 8], self.high[i, : len(b) // 8] = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)

    def meet(self, at: slice, low: np.ndarray, high: np.ndarray, bar: np.ndarray, shape: _Shape) -> np.ndarray:
        """Which blocks may hold rows for the questions ``at``: (questions, blocks)."""
        least, most = bounds(self.vectors[at], low.astype(shape.worked), high.astype(shape.worked))
        windows = (least[:, :, None] <= self.high[at][:, None, :]) & (most[:, :, None] >= np.maximum(self.low[at], bar)[:, None, :])
        return (windows & (self.low[at] <= self.high[at])[:, None, :]).any(axis=2)


def _first_in_windows(asks: DataFrame, blocks: DataFrame, k: int, same_label: bool, shape: _Shape) -> DataFrame:
    """``ask, number, rank, id, score``: for each window its first ``k`` rows with the label, or with another one.

    Rows with the question's own id do not count. Each task holds a group of
    questions and a chunk of zone maps, or a group and a shelf.
    """
    groups = max(1, -(-asks.count() // GROUP_ASKS))
    chunks = max(1, -(-blocks.count() // CHUNK_BLOCKS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grouped = asks.withColumn("g", F.pmod(F.xxhash64("ask"), F.lit(groups)).cast("int"))
    zones = blocks.select("shelf", "low", "high", "held", F.pmod(F.xxhash64("shelf"), F.lit(chunks)).cast("int").alias("z"))
    names = [c.split()[0] for c in ASK.split(", ")]

    def route(key: tuple, own: pa.Table, zone: pa.Table) -> pa.Table:
        asked = _Asks(own, shape)
        low, high = (_as_rows(zone.column(c), shape.stored, shape.width) for c in ("low", "high"))
        shelves, shelf = np.unique(zone.column("shelf").to_numpy(), return_inverse=True)
        needed: list[list[np.ndarray]] = [[] for _ in shelves]
        held = [np.frombuffer(h, np.int64) for h in zone.column("held").to_pylist()]
        for first in range(0, len(asked.ask) if len(shelf) else 0, SLICE_ASKS):
            at = slice(first, first + SLICE_ASKS)
            met = asked.meet(at, low, high, np.full_like(asked.low[at], LEAST), shape)
            for b, labels in enumerate(held):
                has = np.isin(asked.label[at], labels) if same_label else (len(labels) > 1) | (asked.label[at] != labels[0])
                met[:, b] &= has
            for s in range(len(shelves)):
                needed[s].append(first + np.flatnonzero(met[:, shelf == s].any(axis=1)))
        parts = []
        for number, wanted in zip(shelves.tolist(), needed, strict=True):
            part = own.select(names).take(pa.array(np.concatenate([np.zeros(0, np.int64), *wanted]), _LONG))
            extra = [pa.array([n] * part.num_rows, _LONG) for n in (number, key[0].as_py())]
            parts.append(part.append_column("shelf", extra[0]).append_column("g", extra[1]))
        schema = pa.schema([own.schema.field(c) for c in names] + [pa.field("shelf", _LONG), pa.field("g", _LONG)])
        return pa.concat_tables([schema.empty_table(), *parts])

    routed = cut(
        grouped.withColumn("z", every(chunks))
        .groupBy("g", "z")
        .cogroup(zones.withColumn("g", every(groups)).groupBy("g", "z"))
        .applyInArrow(route, f"{ASK}, shelf long, g long")
    )

    def answer(key: tuple, rows: pa.Table, own: pa.Table) -> pa.Table:
        return _answer(rows, own, k, same_label, shape)

    # A shelf is sent once for each group of questions that needs it.
    wanted = routed.select(F.col("shelf").alias("wanted"), F.col("g").alias("by")).distinct()
    tiles = blocks.join(wanted, F.col("shelf") == F.col("wanted"))
    found = (
        tiles.select("wanted", "by", "ids", "labels", "vectors", "low", "high")
        .groupBy("wanted", "by")
        .cogroup(routed.groupBy("shelf", "g"))
        .applyInArrow(answer, "ask long, number int, id long, score long")
    )
    order = Window.partitionBy("ask", "number").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _answer(rows: pa.Table, own: pa.Table, k: int, same_label: bool, shape: _Shape) -> pa.Table:
    asked = _Asks(own, shape)
    windows = asked.low.shape[1]
    low, high = (_as_rows(rows.column(c), shape.stored, shape.width) for c in ("low", "high"))
    ids, labels = ([np.frombuffer(v, np.int64) for v in rows.column(c).to_pylist()] for c in ("ids", "labels"))
    vectors = [np.frombuffer(v, shape.stored).reshape(-1, shape.width).astype(shape.worked) for v in rows.column("vectors").to_pylist()]
    out: list[list[np.ndarray]] = [[], [], [], []]
    for first in range(0, len(asked.ask), SLICE_ASKS):
        at = slice(first, first + SLICE_ASKS)
        bar = np.full_like(asked.low[at], LEAST)
        # What is known so far: question, window, score, id.
        best = [np.zeros(0, np.int64)] * 4
        hopes = asked.meet(at, low, high, bar, shape)
        most = bounds(asked.vectors[at], low.astype(shape.worked), high.astype(shape.worked))[1]
        for b in np.argsort(-np.where(hopes, most, -np.inf).max(axis=0), kind="stable").tolist():
            still = np.flatnonzero(asked.meet(at, low[[b]], high[[b]], bar, shape)[:, 0])
            if not len(still):
                continue
            scores = (asked.vectors[at][still] @ vectors[b].T).astype(np.int64)
            label = labels[b] == asked.label[at][still, None]
            wanted = (label if same_label else ~label) & (ids[b] != asked.id[at][still, None])
            for w in range(windows):
                fits = wanted & (scores >= np.maximum(asked.low[at], bar)[still, w, None]) & (scores <= asked.high[at][still, w, None])
                a, r = np.nonzero(fits)
                new = [still[a], np.full(len(a), w), scores[a, r], ids[b][r]]
                best = [np.concatenate(p) for p in zip(best, new, strict=True)]
            order = np.lexsort((best[3], -best[2], best[1], best[0]))
            best = [v[order] for v in best]
            group = best[0] * windows + best[1]
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
            best = [v[place < k] for v in best]
            full = place == k - 1
            bar[group[full] // windows, group[full] % windows] = best[2][place[place < k] == k - 1]
        for kept, values in zip(out, (asked.ask[at][best[0]], best[1], best[3], best[2]), strict=True):
            kept.append(values)
    columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in out]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["ask", "number", "id", "score"])


def mine(
    df: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as floor(scale * x); a score is the product with the
    anchor, higher ones first, ties by smaller id. An anchor's positives are
    its first rows of its own label, and for each of them its negatives are the
    first rows of another label whose score lies within ``window`` percent of
    the positive's, both ends included: a positive with a score below 0 has
    none. An anchor without positives or negatives has no row.

    Labels are whole numbers. Rows with a null id, label or vector, or a vector
    with null or non-finite parts take no part; shorter vectors count as filled
    with zeros. Rows of one id are rows each, and never partners of one another;
    each row of a repeated anchor is an anchor. 100 times a score must fit into
    64 bits. Other columns are left out.
    """
    spark = df.sparkSession
    x = F.col("x")
    unusable = F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    rows = (
        df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).cast("long").alias("label"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
            F.col(vector_col).cast("array<double>").alias("x"),
        )
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
        .where(~unusable)
        .select("id", "label", "anchor", F.transform(x, lambda y: F.floor(y * scale).cast("long")).alias("v"))
    )
    size = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    width, largest = rows.agg(F.max(F.size("v")), F.max(size)).first()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not width:
        return spark.createDataFrame([], empty)
    shape = _Shape(width, max(1, largest or 0))
    blocks = session_stages(spark).stage(_blocks(rows, shape), "blocks")
    anchors = cut(_anchors(blocks, shape, positives))
    near = cut(_first_in_windows(anchors, blocks, positives, True, shape))

    nearest, farthest = window
    by_rank = near.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found"))

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends: list[list[bytes]] = [[], []]
            for found in batch.column(4).to_pylist():
                scores = np.array([f["score"] for f in found], np.int64)
                ends[0].append((-(-nearest * scores // 100)).tobytes())
                ends[1].append((farthest * scores // 100).tobytes())
            columns = [*batch.columns[:4], *(pa.array(e, _BINARY) for e in ends)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ASK.split(", ")])

    asks = cut(anchors.join(by_rank, "ask").select("ask", "id", "label", "vector", "found").mapInArrow(windows, ASK))
    far = _first_in_windows(asks, blocks, negatives, False, shape)
    pairs = near.select("ask", (F.col("rank") - 1).alias("number"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        far.withColumnRenamed("id", "negative_id")
        .withColumnRenamed("score", "negative_score")
        .join(pairs, ["ask", "number"])
        .join(anchors.select("ask", F.col("id").alias("anchor_id")), "ask")
        .select([c.split()[0] for c in empty.split(", ")])
    )

