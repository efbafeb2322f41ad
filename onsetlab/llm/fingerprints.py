"""Locality-sensitive digests of texts: quartiles of hashed byte triplets, and length.

Byte triplets at fixed distances are hashed into buckets and counted. A digest
holds two hexadecimal digits for the logarithm of the length and two bits for
each bucket: how many of the three quartiles of all bucket counts its own count
exceeds. The difference of two digests is the sum of the steps between their
buckets and their lengths; the likeness is 1 for none and 0 from ``UNLIKE`` on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlab.llm.scratch import cut

BUCKETS = 256
#: Distances of the second and third byte of a triplet. Wide ones see more of a
#: text's own wording and less of what all texts of a language have in common.
TRIPLETS = ((6, 12), (7, 17), (5, 13))
WINDOW = max(far for _, far in TRIPLETS)
#: Two lengths differ by one step for each tenth that one is longer.
LENGTH_BASE = 1.1
LENGTH_WEIGHT, MOST_LENGTH_STEPS = 2, 32
#: Unrelated texts of one length differ by about 1.25 steps a bucket.
UNLIKE = 5 * BUCKETS // 4
SLICE_BYTES, SLICE_ROWS = 1 << 20, 2048
#: Bytes of text in a range of ids; a range is sorted and streamed, not held.
RANGE_BYTES = 128 << 20


def _bucket_counts(texts: Sequence[bytes]) -> np.ndarray:
    """Triplet counts by text and bucket. Each byte starts its triplets; past the end are zeros."""
    gap = bytes(WINDOW)
    data = np.frombuffer(gap.join(texts) + gap, np.uint8).astype(np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(sizes + WINDOW) - sizes - WINDOW
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, firsts, 1)
    np.add.at(inside, firsts + sizes, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    row = np.repeat(np.arange(len(texts)) * BUCKETS, sizes)
    counts = np.zeros(len(texts) * BUCKETS, np.int64)
    for kind, (near, far) in enumerate(TRIPLETS):
        mixed = data[at] * np.uint32(0x9E3779B1) + data[at + near] * np.uint32(0x85EBCA6B)
        mixed += data[at + far] * np.uint32(0xC2B2AE35) + np.uint32(kind * 0x27D4EB2F & 0xFFFFFFFF)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount(row + (mixed >> np.uint32(12)) % BUCKETS, minlength=len(counts))
    return counts.reshape(len(texts), BUCKETS)


def codes_of(texts: Sequence[bytes]) -> np.ndarray:
    """A row per text: its length code, then the quartile code of each bucket."""
    out = np.zeros((len(texts), 1 + BUCKETS), np.uint8)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and last - first < SLICE_ROWS and (last == first or size + len(texts[last]) <= SLICE_BYTES):
            size += len(texts[last])
            last += 1
        part = texts[first:last]
        counts = _bucket_counts(part)
        ordered = np.sort(counts, axis=1)
        for quartile in (1, 2, 3):
            out[first:last, 1:] += counts > ordered[:, [BUCKETS * quartile // 4 - 1]]
        lengths = np.log1p([len(t) for t in part]) / np.log(LENGTH_BASE)
        out[first:last, 0] = np.minimum(np.rint(lengths), 255)
        first = last
    return out


def as_text(codes: np.ndarray) -> list[str]:
    four = codes[:, 1:].reshape(len(codes), -1, 4)
    packed = four[:, :, 0] << 6 | four[:, :, 1] << 4 | four[:, :, 2] << 2 | four[:, :, 3]
    return [row.tobytes().hex() for row in np.concatenate([codes[:, :1], packed.astype(np.uint8)], axis=1)]


def as_codes(digests: Sequence[str]) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), -1)
    four = np.stack([packed[:, 1:] >> shift & 3 for shift in (6, 4, 2, 0)], axis=2)
    return np.concatenate([packed[:, :1], four.reshape(len(packed), -1)], axis=1)


def likeness_of(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Likeness of the digests with these codes, row by row."""
    steps = np.abs(one.astype(np.int32) - other.astype(np.int32))
    difference = steps[:, 1:].sum(axis=1) + LENGTH_WEIGHT * np.minimum(steps[:, 0], MOST_LENGTH_STEPS)
    return 1.0 - np.minimum(difference, UNLIKE) / UNLIKE


def fingerprint(text: Column) -> Column:
    """The digest of a text column; null counts as empty."""

    def digests(values: pd.Series) -> pd.Series:
        return pd.Series(as_text(codes_of([v.encode() for v in values])), dtype=object)

    return F.pandas_udf(digests, "string")(F.coalesce(text, F.lit("")))


def likeness(one: Column, other: Column) -> Column:
    """The likeness of two digests, 0 to 1; null where one of them is null."""

    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        out = pd.Series(np.full(len(a), np.nan), index=a.index)
        both = (a.notna() & b.notna()).to_numpy()
        if both.any():
            out[both] = likeness_of(as_codes(a[both].tolist()), as_codes(b[both].tolist()))
        return out.astype(object).where(both, None)

    return F.pandas_udf(compare, "double")(one, other)


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _compared(texts: list[str], following: list[str]) -> list[list]:
    """The columns of RESULT for texts and the texts that follow them."""
    edited = []
    for own, after in zip(texts, following, strict=True):
        part = len(own) // 3
        edited.append((own[: len(own) - part] + after[:part]).encode())
    own, other, next_one = codes_of([t.encode() for t in texts]), codes_of(edited), codes_of([t.encode() for t in following])
    return [
        [len(t) for t in texts],
        [hashlib.sha256(t).hexdigest() for t in edited],
        as_text(own),
        as_text(other),
        likeness_of(own, other).tolist(),
        likeness_of(own, next_one).tolist(),
    ]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of each text and of an edit of it, and their likeness.

    The rows are taken by descending id, null ids last, rows of one id by the
    xxhash64 of their texts; after the last comes the first. In the edit of a
    text of n code points the last n // 3 are replaced by the first as many of
    the next text, or all if it has fewer. One row per row of ``docs``: its id
    and the columns of RESULT, other columns are left out. A null text counts
    as empty; a single row is its own next one; no rows give none.

    The texts are shuffled once, into ranges of ids that are sorted and streamed
    with one text held back. Only the first and the last text of each range are
    written down for a second step, which joins them range by range.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES)))
    by_id = [F.col("id").desc_nulls_last(), F.col("tie")]
    ordered = (
        texts.withColumn("tie", F.xxhash64("text")).repartitionByRange(ranges, *by_id).sortWithinPartitions(*by_id).drop("tie")
    )
    id_type = docs.schema[id_col].dataType
    id_name = id_type.simpleString()
    kinds = [_ARROW[c.split()[1]] for c in RESULT.split(", ")]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def rows(ids: pa.Array, columns: list[list], part: int, kind: str, whole: list | None = None) -> pa.RecordBatch:
        n = len(ids)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] if columns else [pa.nulls(n, k) for k in kinds]
        edge = [pa.array([part] * n, pa.int64()), pa.array([kind] * n, pa.string()), pa.array(whole or [None] * n, pa.string())]
        return pa.RecordBatch.from_arrays([ids, *arrays, *edge], ["id", *names, "part", "kind", "text"])

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held_id, held = None, None
        for batch in batches:
            own, ids = batch.column(1).to_pylist(), batch.column(0)
            if not own:
                continue
            if held is None:
                yield rows(ids[:1], [], part, "first", own[:1])
            else:
                yield rows(held_id, _compared([held], own[:1]), part, "done")
            for a, b in _slices(own[:-1]):
                yield rows(ids[a:b], _compared(own[a:b], own[a + 1 : b + 1]), part, "done")
            held_id, held = ids[-1:], own[-1]
        if held is not None:
            yield rows(held_id, [], part, "last", [held])

    walked = cut(ordered.mapInArrow(walk, f"id {id_name}, {RESULT}, part long, kind string, text string"))
    done = walked.where("kind = 'done'").select("id", *names)
    # One number for each range that is not empty.
    parts = sorted(r["part"] for r in walked.where("kind = 'first'").select("part").collect())
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part long, next_part long")
    first = walked.where("kind = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    pairs = walked.where("kind = 'last'").join(following, "part").join(first, "next_part").select("id", "text", "next_text")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, after = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in _slices(own):
                columns = [pa.array(c, k) for c, k in zip(_compared(own[a:b], after[a:b]), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *columns], ["id", *names])

    joined = pairs.mapInArrow(finish, f"id {id_name}, {RESULT}")
    return done.unionByName(joined).withColumnRenamed("id", id_col)
