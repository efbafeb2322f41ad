"""Token counts of whole texts with a SentencePiece BPE model.

A huge text is encoded in overlapping chunks. Two chunks are joined inside their
overlap at a boundary on both sides of which they have the same token: every
pair of neighbours in the joined sequence then stands side by side in an
encoding by the same merges, which makes the whole sequence the encoding of the
whole text. Where an overlap has no such place it is widened, in the end to the
rest of the text, so the count never depends on where the chunks lie.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
TEXTS_AT_ONCE = 128

Token = tuple[int, int, int]


def tokens_with_offsets(model, text: str, base: int = 0) -> list[Token]:
    """(start, end, id) of each token, in characters from ``base``."""
    found = model.encode(text, return_type="offset_mapping")
    return [(base + a, base + b, i) for (a, b), i in zip(found["offsets"], found["ids"], strict=True)]


def common_place(left: list[Token], right: list[Token], start: int) -> tuple[int, int] | None:
    """Where both lists have the same two neighbouring tokens at the same offsets.

    Returns how many tokens to keep of ``left`` and how many to skip of
    ``right``. The first tokens of ``right`` see a text that begins at
    ``start`` and are not used. Only tokens of a width above zero count, so
    that a place inside a character that falls back to bytes is never taken.
    """
    whole = lambda t: t[1] > t[0]
    at = {t: i for i, t in enumerate(right) if i and t[0] > start and whole(t)}
    for i in range(len(left) - 2, 0, -1):
        j = at.get(left[i])
        if j and j + 1 < len(right) and left[i + 1] == right[j + 1] and whole(left[i + 1]):
            return i + 1, j + 1
        if left[i][0] < start:
            return None
    return None


def splice(
    model, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, reach: int | None = None
) -> tuple[int, list[Token]]:
    """The tokens of a text of any length: how many were let go, and those after them.

    Kept are those that begin in the last ``reach`` characters (null: all). An
    overlap that has to be widened beyond them is the whole text so far, and no
    chunk is longer than it has to be otherwise.
    """
    end = min(chunk, len(text))
    gone, floor, done = 0, 0, tokens_with_offsets(model, text[:end])
    while end < len(text):
        width = overlap
        while True:
            start = end - width if end - width > floor else 0
            stop = min(len(text), end + chunk)
            part = tokens_with_offsets(model, text[start:stop], start)
            if start == 0:
                gone, floor, done = 0, 0, part
                break
            if place := common_place(done, part, start):
                done = done[: place[0]] + part[place[1] :]
                break
            width *= 2
        end = stop
        if reach is not None and end - reach > floor:
            floor = end - reach
            here = bisect_left(done, floor, key=lambda t: t[0])
            gone, done = gone + here, done[here:]
    return gone, done


def encode_long(model, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[Token]:
    """The tokens of a text of any length."""
    return splice(model, text, chunk, overlap)[1]


def count_long(model, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, reach: int | None = None) -> int:
    """How many tokens a text of any length has; of these only the last ones are held (``reach``, or a chunk)."""
    gone, last = splice(model, text, chunk, overlap, max(chunk, overlap) if reach is None else reach)
    return gone + len(last)


def count_tokens(
    df: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    Null and empty texts have 0 bytes and 0 tokens, null ids stay null and
    repeated rows stay repeated. Other columns are not read. The model file is
    read on the driver and travels with the tasks.
    """
    with open(model_file, "rb") as file:
        proto = file.read()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            counts: list[int] = [0] * len(texts)
            for first in range(0, len(texts), TEXTS_AT_ONCE):
                part = texts.slice(first, TEXTS_AT_ONCE).to_pylist()
                short = [i for i, t in enumerate(part) if len(t) <= chunk]
                encoded = model.encode([part[i] for i in short], num_threads=1, return_type="numpy")
                for i, ids in zip(short, encoded, strict=True):
                    counts[first + i] = len(ids)
                for i, text in enumerate(part):
                    if len(text) > chunk:
                        counts[first + i] = count_long(model, text, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return (
        df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )
