"""Small numpy helpers over the UTF-8 bytes of an Arrow text column."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ODD = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and n + 1 offsets; null is empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, starts, data = column.buffers()
    if starts is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of the result can be used."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD to the i-th and its inverses modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
        for name, base in (("up", ODD), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


#: Longer spans are hashed by a function that no text can be made to fool.
LONG_SPAN = 64


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, long_span: int = LONG_SPAN) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]`` for many spans, equal for equal content.

    Sums of powers modulo 2**64 vanish for the difference of some long strings,
    whatever the base, so spans of more than ``long_span`` go to blake2b.
    """
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts > long_span).tolist():
        digest = hashlib.blake2b(codes[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def release(result: pa.Table) -> pa.Table:
    """Give memory that a group has used back to the system; workers live on for other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system's library has it
        ctypes.CDLL(None).malloc_trim(0)
    return result


def word_spans(
    is_word: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes, and the row of each run."""
    if not len(is_word):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(len(is_word) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], is_word])
    after = np.concatenate([is_word, [False]])
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive words (also across rows)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    grams = words[:n].copy()
    for j in range(1, size):
        grams *= ODD
        grams += words[j : j + n]
    return mix(grams)
