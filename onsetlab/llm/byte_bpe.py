"""Byte-level BPE by a table of ranks, folded over distinct words.

A task writes each text as numbers of its words (the matches of the pattern) and
folds the ranked merges over the bytes of every word once, when it first meets
it: the pair of neighbours of the lowest rank, the leftmost of equals, becomes
one piece, until no pair has a rank. The same task strings the pieces of the
words together; nothing is shuffled.

There are two folds with the same results. The default folds all new words of a
batch side by side in numpy. ``native`` hands new words to Spark's higher-order
functions, with the ranks as literal maps in the plan, one per hash bucket.

Decoding looks up the bytes of each id in a literal list and joins them.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16384
#: Longer words are merged with a heap: the fold copies its list for every merge.
FOLD_BYTES = 256
#: So many distinct words are remembered by a task before it starts afresh.
KNOWN_WORDS = 400_000
TEXTS_AT_ONCE = 2000
NO_RANK = np.int64(1 << 40)

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """Pieces and ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file) if piece}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body).getItem(0)


def rank_maps(ranks: Ranks) -> Column:
    """The ranks as a literal: per hash bucket a map from hex string to rank.

    The JSON text is constant, so the optimiser turns it into the literal once.
    """
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        name = piece.hex().upper()
        buckets[crc32(name.encode()) % BUCKETS][name] = rank
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def rank_lookup(maps: Column):
    """A function from hex strings to their ranks (null: none)."""

    def rank(name: Column) -> Column:
        return F.try_element_at(F.get(maps, F.pmod(F.crc32(name), F.lit(BUCKETS)).cast("int")), name)

    return rank


def merge_word(word: Column, rank) -> Column:
    """The ids of a binary word, by a fold of ranked merges over its bytes."""

    def step(state: Column, _: Column) -> Column:
        parts, ranks = state["parts"], state["ranks"]

        def merge(i: Column) -> Column:
            def rebuilt(piece: Column) -> Column:
                nothing = F.array().cast("array<int>")
                before = F.when(i > 1, F.array(rank(F.concat(F.get(parts, i - 2), piece)))).otherwise(nothing)
                after = F.when(
                    i + 1 < F.size(parts), F.array(rank(F.concat(piece, F.get(parts, i + 1))))
                ).otherwise(nothing)
                return F.struct(
                    F.concat(F.slice(parts, 1, i - 1), F.array(piece), F.slice(parts, i + 2, F.size(parts))).alias("parts"),
                    F.concat(
                        F.slice(ranks, 1, F.greatest(i - 2, F.lit(0))), before, after,
                        F.slice(ranks, i + 2, F.size(parts)),
                    ).alias("ranks"),
                )

            return _let(F.concat(F.get(parts, i - 1), F.get(parts, i)), rebuilt)

        least = F.array_min(ranks)
        return F.when(least.isNull(), state).otherwise(
            _let(F.array_position(ranks, least).cast("int"), merge)
        )

    def folded(name: Column) -> Column:
        def merged(parts: Column) -> Column:
            n = F.size(parts)
            pairs = F.zip_with(
                F.slice(parts, 1, n - 1), F.slice(parts, 2, n - 1), lambda a, b: rank(F.concat(a, b))
            )
            start = F.struct(parts.alias("parts"), pairs.alias("ranks"))
            return F.aggregate(F.sequence(F.lit(2), n), start, step, lambda state: state["parts"])

        pieces = _let(F.regexp_extract_all(name, F.lit(".."), F.lit(0)), merged)
        whole = rank(name)
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(pieces, rank))

    return _let(F.hex(word), folded)


def merge_long(word: bytes, ranks: Ranks) -> list[int]:
    """The same for a long word, with a heap of pairs instead of a fold."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n and (found := ranks.get(word[a : end[b]])) is not None:
            heap.append((found, a, b, end[b])) if not started else heapq.heappush(heap, (found, a, b, end[b]))

    started = False
    for a in range(n - 1):
        offer(a)
    heapq.heapify(heap)
    started = True
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if not alive[a] or end[a] != b or not alive[b] or end[b] != c:
            continue
        end[a], alive[b] = c, False
        if c < n:
            before[c] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a : end[a]]])
        a = end[a]
    return out


class PairTable:
    """Which pairs of ids become which id: each piece in all its divisions in two."""

    def __init__(self, ranks: Ranks):
        pairs = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_RANK where they have none."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(wanted.shape, NO_RANK)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)


def merge_words(words: list[bytes], ranks: Ranks, table: PairTable) -> list[np.ndarray]:
    """The ids of many words, folded side by side with words of the same length."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if word in ranks:
            out[i] = np.array([ranks[word]])
        elif len(word) > FOLD_BYTES:
            out[i] = np.array(merge_long(word, ranks))
        else:
            by_length.setdefault(len(word), []).append(i)
    for length, numbers in by_length.items():
        own = np.array(numbers)
        joined = np.frombuffer(b"".join(words[i] for i in numbers), np.uint8)
        ids = table.bytes[joined.reshape(-1, length)]
        pairs = table.look_up(ids[:, :-1], ids[:, 1:])
        while len(own):
            width = ids.shape[1]
            rows = np.arange(len(own))
            if width > 1:
                at = pairs.argmin(1)
                least = pairs[rows, at]
            else:
                least = np.full(len(own), NO_RANK)
            done = least == NO_RANK
            for i, row in zip(own[done].tolist(), ids[done], strict=True):
                out[i] = row
            own, ids = own[~done], ids[~done]
            if not len(own):
                break
            pairs, at, least, rows = pairs[~done], at[~done], least[~done], np.arange((~done).sum())
            # Each word loses one place, so all stay as wide as each other.
            ids[rows, at] = least
            keep = np.ones(ids.shape, bool)
            keep[rows, at + 1] = False
            ids = ids[keep].reshape(len(own), width - 1)
            keep = np.ones(pairs.shape, bool)
            keep[rows, at] = False
            pairs = pairs[keep].reshape(len(own), width - 2)
            left, right = at > 0, at < width - 2
            pairs[rows[left], at[left] - 1] = table.look_up(ids[rows[left], at[left] - 1], ids[rows[left], at[left]])
            pairs[rows[right], at[right]] = table.look_up(ids[rows[right], at[right]], ids[rows[right], at[right] + 1])
    return out


class WordNumbers:
    """Numbers of the words that a task has met, and the new ones of each text."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def read(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        known = self.known
        found, start = self.find(text), len(known)
        numbers = [known.setdefault(word, len(known)) for word in found]
        fresh = dict.fromkeys(w for w, n in zip(found, numbers, strict=True) if n >= start) if len(known) > start else ()
        return np.array(numbers, np.int32), [word.encode() for word in fresh]


def encode(
    df: DataFrame,
    ranks: Ranks,
    pattern: str,
    text_col: str = "text",
    name: str = "ids",
    native: bool = False,
    known_words: int = KNOWN_WORDS,
) -> DataFrame:
    """All columns of ``df`` and ``name``: the ids of the text, an ``array<int>``.

    Each match of ``pattern`` is encoded for itself. Null and empty texts have
    no ids. A column called ``name`` is replaced; with ``native`` the names
    ``_words``, ``_fresh``, ``_long``, ``_again`` and ``_ids`` are taken.
    ``ranks`` must hold all single bytes. A task holds at most ``known_words``
    words and those of one portion of texts.
    """
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"ranks lack {len(missing)} single bytes")
    if native:
        return _encode_native(df, ranks, pattern, text_col, name, known_words)
    used = [c for c in df.columns if c != name]
    df = df.select(*(df[c] for c in used))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, words, ids = PairTable(ranks), WordNumbers(pattern), WordIds()
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                if len(words.known) > known_words:
                    words, ids = WordNumbers(pattern), WordIds()
                numbers, fresh = [], []
                for text in pc.fill_null(batch.column(batch.schema.get_field_index(text_col)).cast(pa.string()), "").to_pylist():
                    own, new = words.read(text)
                    numbers.append(own)
                    fresh += new
                if fresh:
                    merged = merge_words(fresh, ranks, table)
                    ids.add(np.concatenate(merged).astype(np.int32), np.array([len(m) for m in merged]), [])
                yield _with_lists(batch, used, [ids.ids_of(n) for n in numbers], name)

    return df.mapInArrow(write, _with_fields(df.schema, {name: "array<int>"}))


def _with_lists(batch: pa.RecordBatch, used: list[str], lists: list[np.ndarray], name: str) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = pa.array(np.concatenate([np.zeros(0, np.int32), *lists]), pa.int32())
    columns = [batch.column(c) for c in used]
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), flat)], [*used, name])


def _encode_native(df: DataFrame, ranks: Ranks, pattern: str, text_col: str, name: str, known_words: int) -> DataFrame:
    used = [c for c in df.columns if c not in (name, "_words", "_fresh", "_long", "_again", "_ids")]
    df = df.select(*(df[c] for c in used))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordNumbers(pattern)
        for batch in batches:
            words, fresh, longs, again = [], [], [], []
            for text in pc.fill_null(batch.column(batch.schema.get_field_index(text_col)).cast(pa.string()), "").to_pylist():
                again.append(len(known.known) > known_words)
                if again[-1]:
                    known = WordNumbers(pattern)
                numbers, new = known.read(text)
                words.append(numbers.tobytes())
                fresh.append([w if len(w) <= FOLD_BYTES else b"" for w in new])
                longs.append([np.array(merge_long(w, ranks), np.int32).tobytes() for w in new if len(w) > FOLD_BYTES])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(words, pa.binary()), pa.array(fresh, pa.list_(pa.binary())),
                 pa.array(longs, pa.list_(pa.binary())), pa.array(again, pa.bool_())],
                [*batch.schema.names, "_words", "_fresh", "_long", "_again"],
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordIds()
        for batch in batches:
            parts = []
            longs, (bounds, inner, ids) = batch.column("_long").to_pylist(), list_buffers(batch.column("_ids"))
            rows = zip(batch.column("_words").to_pylist(), batch.column("_again").to_pylist(), strict=True)
            for i, (words, again) in enumerate(rows):
                if again:
                    table = WordIds()
                if bounds[i + 1] > bounds[i]:
                    cuts = inner[bounds[i] : bounds[i + 1] + 1]
                    table.add(ids[cuts[0] : cuts[-1]], np.diff(cuts), [np.frombuffer(b, np.int32) for b in longs[i]])
                parts.append(table.ids_of(np.frombuffer(words, np.int32)))
            yield _with_lists(batch, used, parts, name)

    def merged(maps: Column) -> Column:
        rank, nothing = rank_lookup(maps), F.array().cast("array<int>")
        return F.transform("_fresh", lambda w: F.when(F.length(w) > 0, merge_word(w, rank)).otherwise(nothing))

    more = {"_words": "binary", "_fresh": "array<binary>", "_long": "array<binary>", "_again": "boolean"}
    return (
        df.mapInArrow(split, _with_fields(df.schema, more))
        .withColumn("_ids", _let(rank_maps(ranks), merged))
        .drop("_fresh")
        .mapInArrow(join, _with_fields(df.schema, {name: "array<int>"}))
    )


def _with_fields(schema: T.StructType, more: dict[str, str]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, T.DataType.fromDDL(k)) for n, k in more.items())])


class WordIds:
    """The ids of the words of a task, one after another, growing by doubling."""

    def __init__(self) -> None:
        self.ids, self.used = np.zeros(1 << 12, np.int32), 0
        self.starts, self.sizes, self.words = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, longs: list[np.ndarray]) -> None:
        """New words: their sizes, where 0 stands for the next of ``longs``."""
        if longs:
            empty = np.flatnonzero(sizes == 0)
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, part in zip(empty.tolist(), longs, strict=True):
                parts[i] = part
            ids, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.words + len(sizes) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        here = slice(self.words, self.words + len(sizes))
        self.starts[here] = self.used + np.cumsum(sizes) - sizes
        self.sizes[here] = sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.words += len(sizes)

    def ids_of(self, words: np.ndarray) -> np.ndarray:
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[words] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at]


def list_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the outer and the inner lists and the numbers of an ``array<array<int>>``."""
    outer = np.asarray(column.offsets).astype(np.int64)
    middle = column.values
    inner = np.asarray(middle.offsets).astype(np.int64)
    return outer, inner, np.asarray(middle.values)


def decode(df: DataFrame, ranks: Ranks, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns and ``name``: the bytes of the ids, one piece after another.

    Null ids stay null, no ids are no bytes. An id without a piece raises.
    """
    size = max(ranks.values()) + 1
    pieces = [""] * size
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex().upper()
    listed = F.split(F.lit(",".join(pieces)), ",")
    joined = F.array_join(F.transform(ids_col, lambda i: F.element_at(listed, i + 1)), "")
    return df.withColumn(name, F.unhex(joined))
