"""Training documents that hold passages of a benchmark, found by winnowing.

Of every ``window`` words the smallest hash of ``gram`` consecutive words is
kept as fingerprint, on both sides by the same rule. A window that a document
shares with an item therefore shares a fingerprint with it. The fingerprints of
both sides are joined; every hit is then extended to the windows around it,
which are compared word by word with those of the items, and windows that touch
become one span.

Both sides are made in tasks. A table of bits, of bounded size, spares the join
the fingerprints that no item has, so texts are never shuffled for it: what is
shuffled is stretches of at most ``2 * window - gram`` words, once for each
different text. Tables of the benchmark are copied to the tasks where they are
measured to fit, and shuffled where not, with frequent keys divided.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlab.llm.buffers import gram_hashes, slices, span_hashes, utf8, word_spans
from onsetlab.operators.lookup import BROADCAST_BYTES, lookup_join
from onsetlab.sources.staging import measured, session_stages

WINDOW = 10
GRAM = 5
#: Binary logarithm of the bits that stand for all fingerprints of a benchmark: 128 KB to 16 MB.
LEAST_BITS, MOST_BITS = 20, 27

#: Byte to word byte: A-Z become a-z, and 0 stands for every byte between words.
WORD_BYTES = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORD_BYTES[_b] = _b
WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, starts, ends, rows and hashes of all words."""
    codes = WORD_BYTES[data]
    starts, ends, rows = word_spans(codes != 0, offsets)
    return codes, starts, ends, rows, span_hashes(codes, starts, ends)


def window_minima(words: np.ndarray, rows: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest gram hash of each window of one row, and where the windows start."""
    grams = gram_hashes(words, gram)
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least, width, wanted = grams, 1, window - gram + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    whole = np.flatnonzero(rows[:n] == rows[window - 1 :])
    return least[whole], whole


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlaps; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((int(first), int(last)))
    return out


def _stretches(rows: np.ndarray, hashes: np.ndarray, window: int, gram: int, wanted: Callable) -> Iterator[tuple]:
    """Fingerprints that are ``wanted``, and the first and last word of the windows that may have chosen them."""
    least, at = window_minima(hashes, rows, window, gram)
    kept = np.flatnonzero(wanted(least))
    grams = gram_hashes(hashes, gram)
    done = -1
    for k in kept.tolist():
        place = int(at[k])
        first = place + int(np.argmin(grams[place : place + window - gram + 1]))
        if first != done:
            # The windows that chose this gram follow each other; the last one begins at it or earlier.
            done, low = first, place
            high = min(first, place + window - gram)
            while high > low and (high + window > len(rows) or rows[high + window - 1] != rows[place]):
                high -= 1
            yield int(rows[place]), int(least[k]), low, high + window


def _whole(rows: np.ndarray, hashes: np.ndarray, size: int, wanted: Callable) -> Iterator[tuple]:
    """Runs of ``size`` words of one row whose hash is ``wanted``."""
    grams = gram_hashes(hashes, size)
    for first in np.flatnonzero(wanted(grams)).tolist():
        if rows[first] == rows[first + size - 1]:
            yield int(rows[first]), int(grams[first]), first, first + size


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


ITEM_WINDOWS = "item string, size int, print long, window string"


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """Each window of each item, once, with its fingerprint; an item of fewer words is one window."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("item").to_pylist()
            codes, starts, ends, rows, hashes = split_words(data, offsets)
            bounds = np.searchsorted(rows, np.arange(len(offsets)))
            least, at = window_minima(hashes, rows, window, gram)
            found = [(int(rows[p]), window, int(v), int(p)) for v, p in zip(least, at, strict=True)]
            for row, size in enumerate(np.diff(bounds).tolist()):
                if 0 < size < window:
                    p = int(bounds[row])
                    found.append((row, size, int(gram_hashes(hashes[p : p + size], size)[0]), p))
            words = [codes[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
            columns = [
                pa.array([ids[row] for row, *_ in found], pa.string()),
                pa.array([size for _, size, _, _ in found], pa.int32()),
                _signed([value for _, _, value, _ in found]),
                pa.array([" ".join(words[p : p + size]) for _, size, _, p in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "size", "print", "window"])

    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL")
    return items.mapInArrow(build, ITEM_WINDOWS).distinct()


def _bits(windows: DataFrame) -> tuple[int, bytes]:
    """A table of bits, one for each leading part of a fingerprint that occurs, and the length of those parts."""
    size = min(max(LEAST_BITS, measured(windows)["rows"].bit_length() + 6), MOST_BITS)
    slot = F.shiftrightunsigned("print", 64 - size) + 1
    parts = windows.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    table = np.zeros(1 << (size - 3), np.uint8)
    for part, bits in parts.collect():
        table[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, np.uint8)
    return size, table.tobytes()


HITS = "key string, print long, size int, first long, stretch string"


def document_hits(texts: DataFrame, size: int, bits: bytes, short: list[int], window: int, gram: int) -> DataFrame:
    """Stretches of words around the fingerprints that the bits know; each different text once."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)
        wanted = lambda values: known[(values >> np.uint64(64 - size)).astype(np.int64)]
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            keys = batch.column("key").to_pylist()
            for a, b in slices(offsets):
                own = offsets[a : b + 1] - offsets[a]
                codes, starts, ends, rows, hashes = split_words(data[offsets[a] : offsets[b]], own)
                bounds = np.searchsorted(rows, np.arange(len(own)))
                found = [(window, *hit) for hit in _stretches(rows, hashes, window, gram, wanted)]
                for n in short:
                    found += [(n, *hit) for hit in _whole(rows, hashes, n, wanted)]
                if found:
                    columns = [
                        pa.array([keys[a + row] for _, row, *_ in found], pa.string()),
                        _signed([value for _, _, value, _, _ in found]),
                        pa.array([n for n, *_ in found], pa.int32()),
                        pa.array([low - int(bounds[row]) for _, row, _, low, _ in found], pa.int64()),
                        pa.array(
                            [
                                " ".join(codes[starts[i] : ends[i]].tobytes().decode() for i in range(low, high))
                                for _, _, _, low, high in found
                            ],
                            pa.string(),
                        ),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "print", "size", "first", "stretch"])

    return texts.mapInArrow(find, HITS).distinct()


def _windows_of(stretch: str, size: str, first: str) -> Column:
    """The windows of a stretch, and the words they begin and end with."""
    words = F.split(stretch, " ")
    one = lambda i: F.struct(
        F.array_join(F.slice(words, i + 1, F.col(size)), " ").alias("window"),
        (F.col(first) + i).alias("first"),
        (F.col(first) + i + F.col(size)).alias("last"),
    )
    return F.transform(F.sequence(F.lit(0), F.size(words) - F.col(size)), one)


SPANS = "array<struct<first:long,last:long>>"


def _merged_spans(spans: pd.Series) -> pd.Series:
    return spans.map(lambda of: [{"first": a, "last": b} for a, b in merged([(s["first"], s["last"]) for s in of])])


def _word_counts(texts: pd.Series) -> pd.Series:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    counts = [np.zeros(0, np.int64)]
    for a, b in slices(offsets):
        own = offsets[a : b + 1] - offsets[a]
        rows = word_spans(WORD_BYTES[data[offsets[a] : offsets[b]]] != 0, own)[2]
        counts.append(np.bincount(rows, minlength=b - a))
    return pd.Series(np.concatenate(counts))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All columns of ``docs`` and ``found``: n_words, hit word spans, item ids.

    ``found.spans`` are ranges of word numbers (end not included), sorted and
    apart; ``found.items`` the ids, as sorted strings, of the items of which a
    window occurs. An item of fewer than ``window`` words counts as a whole.
    Null and empty texts have no words. Items with a null id or no words take
    no part; rows of one item id count as one item. Repeated documents are
    judged each for itself. A column of ``docs`` named ``found`` is replaced.

    Tables of up to ``block_bytes`` are copied to the tasks. Texts are told
    apart by their SHA-256.
    """
    if not 1 <= gram <= window:
        raise ValueError("a window must hold at least one gram")
    stages = session_stages(docs.sparkSession)
    windows = stages.stage(item_windows(benchmark, item_col, item_text_col, window, gram), "item_windows")
    short = sorted(size for (size,) in windows.where(F.col("size") < window).select("size").distinct().collect())

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.sha2(text, 256).alias("key"), text.alias("text"))
    hits = document_hits(texts, *_bits(windows), short, window, gram)
    # The join of the fingerprints, and the windows around those that both sides have.
    prints = windows.select("print").distinct()
    met = lookup_join(hits, prints, "print", "left_semi", ["key", "first"], block_bytes)
    around = met.select("key", F.explode(_windows_of("stretch", "size", "first")).alias("w")).select("key", "w.*").distinct()
    same = lookup_join(around, windows.select("window").distinct(), "window", "left_semi", ["key", "first"], block_bytes)
    same = stages.stage(same, "shared_windows")

    spans = same.select("key", "first", "last").distinct().groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    named = lookup_join(
        same.select("key", "window").distinct(), windows.select("window", "item").distinct(), "window", "inner", ["key"], block_bytes
    )
    items = named.select("key", "item").distinct().groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    # As text, whose size is measured before it is copied anywhere.
    found = spans.join(items, "key").select("key", F.to_json(F.struct(F.pandas_udf(_merged_spans, SPANS)("spans").alias("spans"), "items")).alias("hits"))

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "found"]).alias("row"),
        F.pandas_udf(_word_counts, "long")(text).alias("n_words"),
        F.sha2(text, 256).alias("key"),
        F.monotonically_increasing_id().alias("place"),
    )
    judged = lookup_join(rows, stages.stage(found, "found"), "key", "left", ["place"], block_bytes)
    parts = F.from_json("hits", f"spans {SPANS}, items array<string>")
    return judged.select(
        "row.*",
        F.struct(
            "n_words",
            F.coalesce(parts["spans"], F.array().cast(SPANS)).alias("spans"),
            F.coalesce(parts["items"], F.array().cast("array<string>")).alias("items"),
        ).alias("found"),
    )
