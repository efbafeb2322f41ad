"""Blocks of documents and the notes that travel between blocks and shards.

A note is a row of a few packed arrays for one block or shard. Blocks are dealt
by a hash of the id, so a document's notes find it without a join on texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOTES = "block long, kind string, first binary, second binary, third binary"
LEAST_SHARDS = 16
#: Weights below this are not sent, and count as this.
LEAST_WEIGHT = 64
#: Set in the level of a number that is heavier than wanted.
HEAVY = 128
_KINDS = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = ["block", "kind", "first", "second", "third"]


def notes(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def of_kind(table: pa.Table, kind: str) -> Iterator[tuple[bytes, bytes, bytes]]:
    """The packed arrays of the notes of a kind."""
    columns = (table.column(c).to_pylist() for c in _NAMES[1:])
    for own, *values in zip(*columns, strict=True):
        if own == kind:
            yield tuple(values)


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def pack(values: np.ndarray) -> bytes:
    """48-bit numbers, six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising 48-bit numbers: by their steps where these fit into 32 bits."""
    steps = np.diff(values)
    if len(values) and (not len(steps) or steps.max() < 1 << 32):
        return b"\1" + pack(values[:1]) + steps.astype("<u4").tobytes()
    return b"\0" + pack(values)


def unpack_sorted(data: bytes) -> np.ndarray:
    if data[:1] != b"\1":
        return unpack(data[1:])
    steps = np.frombuffer(data[7:], "<u4").astype(np.uint64)
    return unpack(data[1:7])[0] + np.concatenate([np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)])


def block_of(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).alias("block")


def blocks_and_shards(texts: DataFrame, column: str, block_bytes: int, shard_bytes: int) -> tuple[int, int]:
    """Numbers of blocks and shards for the bytes of a text column."""
    total = texts.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]
    return int(max(1, -(-total // block_bytes))), int(max(LEAST_SHARDS, -(-total // shard_bytes)))


def copies_by_block(keys: DataFrame, blocks: int) -> DataFrame:
    """Notes ``copies``: ids (64-bit) and 16-byte keys of rows whose ``key`` a smaller ``id`` has.

    An id may have rows of several keys, of which only some are copies.
    """
    smallest = keys.groupBy("key").agg(F.min("id").alias("smallest"))
    return (
        keys.join(smallest, "key")
        .where("id > smallest")
        .select("id", "key", block_of("id", blocks))
        # Ends the join's stage, so that a key with very many copies is divided there.
        .hint("rebalance")
        .groupBy("block")
        .agg(F.collect_set(F.struct("id", "key")).alias("rows"))
        .mapInArrow(_copy_notes, NOTES)
    )


def _copy_notes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (block, "copies", np.array([r["id"] for r in found], np.int64).tobytes(), b"".join(r["key"] for r in found), b"")
            for block, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        ]
        yield from notes(rows).to_batches()


def copies_in(table: pa.Table, ids: np.ndarray, key: Callable[[int], bytes]) -> np.ndarray:
    """Which rows are copies by the notes of their block; ``key`` tells the key of a row."""
    known = {
        (int(own), keys[16 * i : 16 * i + 16])
        for first, keys, _ in of_kind(table, "copies")
        for i, own in enumerate(numbers(first))
    }
    out = np.isin(ids, np.array([own for own, _ in known], np.int64))
    for i in np.flatnonzero(out).tolist():
        out[i] = (int(ids[i]), key(i)) in known
    return out


def shard_notes(
    values: np.ndarray, ids: np.ndarray, block: int, shards: int, weights: np.ndarray | None = None
) -> pa.Table:
    """What a block holds, by shard: numbers of one id, and of several ids; which of them are heavy."""
    order = np.lexsort((ids, values))
    own = weights[order] if weights is not None else None
    values, ids = values[order], ids[order]
    known, first = np.unique(values, return_index=True)
    last = np.append(first[1:], len(values)) - 1
    many = ids[first] != ids[last] if len(known) else np.zeros(0, bool)
    weight = np.add.reduceat(own, first) if own is not None and len(known) else np.zeros(len(known), np.int64)
    # Shards are ranges of the 48-bit numbers, so that steps stay small.
    cuts = np.searchsorted(known, np.array([(s << 48) // shards for s in range(shards)] + [1 << 48], np.uint64))
    rows = []
    for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if b > a:
            here, several = known[a:b], many[a:b]
            heavy = np.flatnonzero(weight[a:b] >= LEAST_WEIGHT)
            third = np.stack([here[heavy].view(np.int64), weight[a:b][heavy]]).tobytes() if len(heavy) else b""
            rows.append((s, str(block), pack_sorted(here[~several]), pack_sorted(here[several]), third))
    return notes(rows)


def repeated_notes(table: pa.Table, most: int | None = None) -> pa.Table:
    """For each block its numbers that several ids hold, in notes ``hits``.

    Numbers are told apart by level: the binary logarithm of the blocks that
    hold them, in ``second``, and HEAVY more where all blocks together give a
    number a weight over ``most``.
    """
    blocks = table.column("kind").to_pylist()
    ones = [unpack_sorted(v) for v in table.column("first").to_pylist()]
    many = [unpack_sorted(v) for v in table.column("second").to_pylist()]
    # A block that holds a number several times counts twice.
    known, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *ones, *many, *many]), return_counts=True)
    repeated = counts > 1
    known, levels = known[repeated], np.log2(counts[repeated]).astype(np.uint8)
    if most is not None and len(known):
        weight = counts[repeated] * LEAST_WEIGHT
        for value, more in (numbers(v).reshape(2, -1) for v in table.column("third").to_pylist() if v):
            at = np.minimum(np.searchsorted(known, value.view(np.uint64)), len(known) - 1)
            met = known[at] == value.view(np.uint64)
            weight[at[met]] += more[met]
        levels[weight > most] |= HEAVY
    rows = []
    for block, one, several in zip(blocks, ones, many, strict=True):
        own = np.concatenate([one, several])
        at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
        at = np.sort(at[known[at] == own]) if len(known) else np.zeros(0, np.int64)
        if len(at):
            rows.append((int(block), "hits", pack_sorted(known[at]), levels[at].tobytes(), b""))
    return notes(rows)


def hits_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers and their levels from the notes ``hits`` of a block."""
    found = [(unpack_sorted(a), np.frombuffer(b, np.uint8)) for a, b, _ in of_kind(table, "hits")]
    values = np.concatenate([np.zeros(0, np.uint64), *(v for v, _ in found)])
    levels = np.concatenate([np.zeros(0, np.uint8), *(level for _, level in found)])
    order = np.argsort(values, kind="stable")
    return values[order], levels[order]
