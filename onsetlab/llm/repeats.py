"""Repeated byte strings across documents, from enhanced suffix arrays in shards.

Every string of ``length`` bytes has an anchor: the smallest hash among its
``GRAM``-byte substrings. Equal strings have equal anchors, so what repeats can
be found anchor by anchor:

1. Each block of documents says which anchors it holds; anchors that occur in
   one document only are forgotten.
2. The stretches of text around the other anchors go to the shard of their
   anchor, each different stretch of a block once.
3. A shard sorts the suffixes of its stretches, but for those whose first
   ``length`` bytes one document alone has, takes common prefixes of neighbours
   and walks the tree of common-prefix intervals with a stack. An interval whose
   suffixes differ in the byte to their left is a maximal repeat; its occurrences
   are all suffixes of the interval, and the smallest document among them owns
   it. Where an anchor has more windows than a shard should sort at once, each
   different window of a block goes alone to the shard of its own hash, so that
   equal windows still meet.
4. Back in its block, every occurrence outside the owner is marked.

Texts are shuffled once, to their blocks; equal texts are told apart by hash
before, so a group of copies weighs as one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlab.llm.blocks import (
    HEAVY,
    NOTES,
    block_of,
    blocks_and_shards,
    copies_by_block,
    copies_in,
    hits_in,
    notes,
    numbers,
    of_kind,
    repeated_notes,
    shard_notes,
)
from onsetlab.llm.buffers import ODD, release, slices, span_hashes, utf8

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
STRETCH_WINDOWS = 64
PORTION_BYTES = 1 << 20
ANCHOR_WINDOWS = 1 << 17
#: Stretches are no longer than this, unless windows are: one multiplication a byte tells them apart.
LONGEST_PLAIN = 128
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: The first 0 to 8 bytes of a big-endian number.
_LEADING = np.array([(1 << 64) - (1 << (64 - 8 * i)) for i in range(9)], np.uint64)


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each byte the anchor of the window that starts there, 48 bits; _NONE without window."""
    out = np.full(len(data), _NONE, np.uint64)
    starts = np.arange(max(len(data) - gram + 1, 0))
    least = span_hashes(data, starts, starts + gram) >> np.uint64(16)
    width, wanted = 1, length - gram + 1
    while width < wanted and len(least):
        step = min(width, wanted - width)
        least = np.minimum(least[: max(len(least) - step, 0)], least[step:])
        width += step
    # Minima crowd at the low end; an odd factor spreads them over all shards again.
    out[: len(least)] = (least * ODD) & np.uint64((1 << 48) - 1)
    # Windows do not cross documents: the last ones of each start none.
    last = np.zeros(len(data) + 1, np.int32)
    short = np.maximum(offsets[1:] - length + 1, offsets[:-1])
    np.add.at(last, short, 1)
    np.add.at(last, offsets[1:], -1)
    out[np.cumsum(last[:-1]) > 0] = _NONE
    return out


@dataclass
class Stretches:
    """Runs of windows with one anchor: where they lie, whose they are, which are equal.

    Those of a heavy anchor are divided into single windows, with the hash of
    the window in place of the anchor.
    """

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    anchors: np.ndarray
    number: np.ndarray
    first: np.ndarray

    @classmethod
    def of(
        cls, data: np.ndarray, offsets: np.ndarray, hits: np.ndarray, length: int, gram: int, heavy: np.ndarray | None = None
    ) -> Stretches:
        """Stretches around the anchors in the sorted ``hits``, equal ones with one number."""
        heavy = np.zeros(len(hits), bool) if heavy is None else heavy
        parts = []
        for a, b in slices(offsets):
            base, here = offsets[a], data[offsets[a] : offsets[b]]
            anchors = window_anchors(here, offsets[a : b + 1] - base, length, gram)
            edge = np.ones(len(anchors), bool)
            edge[1:] = anchors[1:] != anchors[:-1]
            bounds = (offsets[a:b] - base)[offsets[a:b] < offsets[b]]
            edge[bounds] = True
            starts = np.flatnonzero(edge)
            ends = np.append(starts[1:], len(anchors))
            known = anchors[starts]
            at = np.minimum(np.searchsorted(hits, known), max(len(hits) - 1, 0))
            keep = (hits[at] == known) & (known != _NONE) if len(hits) else np.zeros(len(known), bool)
            starts, ends, known = starts[keep], ends[keep], known[keep]
            alone = heavy[at[keep]] if len(hits) else keep[:0]
            # Long runs, as in "aaaa", are cut; windows stay whole.
            step = np.where(alone, 1, STRETCH_WINDOWS)
            pieces = -(-(ends - starts) // step)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            step = np.repeat(step, pieces)
            starts = np.repeat(starts, pieces) + nth * step
            ends = np.minimum(starts + step, np.repeat(ends, pieces)) + length - 1
            rows = np.searchsorted(offsets, starts + base, "right") - 1
            hashes = span_hashes(here, starts, ends, LONGEST_PLAIN)
            known = np.where(np.repeat(alone, pieces), hashes >> np.uint64(16), np.repeat(known, pieces))
            parts.append((starts + base, ends + base, rows, known, hashes))
        none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
        starts, ends, rows, known, hashes = map(np.concatenate, zip(none, *parts, strict=True))
        _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        return cls(starts, ends, rows, known, number, first)


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes of strings, and what each shares with the one before it in that order.

    ``data`` holds the strings one after another, ``ends`` where each byte's
    string ends; a suffix begins at ``starts`` and counts ``lengths`` bytes. Every
    8 bytes of the strings are a number with a rank, so a suffix is a few ranks,
    several in a key. Past its end a string counts as zeros up to the next such
    piece and then as less than anything.
    """
    n, width = len(data), int(lengths.max(initial=1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
    words &= _LEADING[np.minimum(ends - np.arange(n), 8)]
    # 0 is for what lies past the end.
    ranks = np.unique(words, return_inverse=True)[1] + 1
    bits = n.bit_length()
    keys, room = [], 0
    for k in range(0, width, 8):
        inside = lengths > k
        piece = np.zeros(len(starts), np.int64)
        piece[inside] = ranks[starts[inside] + k]
        if room < bits:
            keys.append(piece)
            room = 63 - bits
        else:
            keys[-1] = keys[-1] << bits | piece
            room -= bits
    order = np.lexsort(keys[::-1])
    common = np.zeros(len(starts), np.int32)
    one, other = starts[order[1:]], starts[order[:-1]]
    most = np.minimum(lengths[order[1:]], lengths[order[:-1]])
    shared = np.zeros(len(one), np.int32)
    alike = np.arange(len(one))
    for k in range(0, width, 8):
        alike = alike[most[alike] > k]
        differ = words[one[alike] + k] ^ words[other[alike] + k]
        apart = differ != 0
        shared[alike[~apart]] = k + 8
        here, differ = np.full(apart.sum(), k, np.int32), differ[apart]
        for j in range(1, 8):
            here += differ >> np.uint64(64 - 8 * j) == 0
        shared[alike[apart]] = here
        alike = alike[~apart]
    common[1:] = np.minimum(shared, most)
    return order, common


def maximal_repeats(order: np.ndarray, shared: np.ndarray, left: np.ndarray, owner: np.ndarray, least: int):
    """Maximal repeats of a set of suffixes, as intervals of their sorted order.

    ``order`` and ``shared`` are those of :func:`sorted_suffixes`, ``left`` the
    byte before each suffix (-1: none, differs from all), ``owner`` the number of
    its document. Returns, per maximal repeat, first and last position in the
    order, length, and smallest owner.
    """
    common = np.append(shared.astype(np.int64), 0)
    side, mine = left[order], owner[order]
    differ = np.zeros(len(order), np.int64)
    differ[1:] = np.cumsum((side[1:] != side[:-1]) | (side[1:] < 0))
    # Only runs of suffixes with long enough prefixes matter. One prefix for the whole run makes one interval.
    long = common >= least
    begins, ends = np.flatnonzero(~long[:-1] & long[1:]), np.flatnonzero(long[:-1] & ~long[1:])
    inner = np.stack([begins + 1, ends + 1], axis=1).ravel()
    lowest, highest = (f.reduceat(common, inner)[::2] if len(inner) else inner for f in (np.minimum, np.maximum))
    runs = np.stack([begins, ends + 1], axis=1).ravel()
    owned = np.minimum.reduceat(np.append(mine, 0), runs)[::2] if len(runs) else runs
    even = lowest == highest
    plain = even & (differ[ends] > differ[begins])
    found = list(zip(*(x[plain].tolist() for x in (begins, ends, lowest, owned)), strict=True))
    stack: list[list[int]] = []  # first position, length, smallest owner
    # The stack is empty between the other runs.
    sizes = (ends - begins + 1)[~even]
    near = (np.repeat(begins[~even] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())).tolist()
    previous, after, owners, changes = common[:-1].tolist(), common[1:].tolist(), mine.tolist(), differ.tolist()
    for i in near:
        # The suffix at i opens or joins intervals; those longer than what follows close.
        here, smallest, first = after[i], owners[i], i
        if previous[i] < least:
            stack.clear()
        elif stack and stack[-1][2] > smallest:
            stack[-1][2] = smallest
        while stack and stack[-1][1] > here:
            first, size, lowest = stack.pop()
            smallest = min(smallest, lowest)
            if changes[i] > changes[first]:
                found.append((first, i, size, smallest))
            if stack and stack[-1][2] > smallest:
                stack[-1][2] = smallest
        if here >= least and (not stack or stack[-1][1] < here):
            stack.append([first, here, smallest])
    return found


def held_by_several(data: np.ndarray, starts: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Which windows of ``width`` bytes may have equals of another owner.

    Equal windows have equal hashes; different ones with one hash stay, too.
    """
    hashes = span_hashes(data, starts, starts + width, width)
    order = np.argsort(hashes)
    edge = np.ones(len(order), bool)
    edge[1:] = hashes[order[1:]] != hashes[order[:-1]]
    first = np.flatnonzero(edge)
    mine = owner[order]
    several = np.minimum.reduceat(mine, first) < np.maximum.reduceat(mine, first)
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(several, np.diff(np.append(first, len(order))))
    return out


def marks_in_shard(strings: bytes, sizes: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """String number, offset and length of every occurrence that is not its owner's.

    A suffix whose first ``least`` bytes no other owner has can neither be
    marked nor mark another, so only the others are sorted.
    """
    data = np.frombuffer(strings, np.uint8)
    counts = sizes - least + 1
    number = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    if len(number):
        start = (np.cumsum(sizes) - sizes)[number] + offset
        kept = held_by_several(data, start, owner[number], least)
        number, offset = number[kept], offset[kept]
    if not len(number):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    used = np.zeros(len(sizes), bool)
    used[number] = True
    data = data[np.repeat(used, sizes)]
    ends = np.cumsum(np.where(used, sizes, 0))
    start = (ends - sizes)[number] + offset
    order, shared = sorted_suffixes(data, start, ends[number] - start, np.repeat(ends[used], sizes[used]))
    left = np.where(offset > 0, data[np.maximum(start - 1, 0)].astype(np.int16), np.int16(-1))
    found = maximal_repeats(order, shared, left, owner[number], least)
    longest = np.zeros(len(start), np.int64)
    mine = owner[number][order]
    for first, last, size, smallest in sorted(found, key=lambda r: r[2]):
        part = longest[first : last + 1]
        part[mine[first : last + 1] > smallest] = size
    hit = np.flatnonzero(longest)
    return number[order[hit]], offset[order[hit]], longest[hit]


class Block:
    """The documents of a block in the order of their ids; copies have no text of their own."""

    def __init__(self, docs: pa.Table, table: pa.Table):
        self.docs = docs.sort_by("id").combine_chunks()
        self.hits, levels = hits_in(table)
        self.heavy = levels >= HEAVY
        self.ids = self.docs.column("id").to_numpy()
        texts = self.docs.column("text")
        self.is_copy = copies_in(table, self.ids, lambda i: md5(texts[i].as_py().encode()).digest())
        self.data, self.offsets = utf8(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
        self.sizes = np.diff(self.offsets)
        if self.is_copy.any():
            self.data = self.data[np.repeat(~self.is_copy, self.sizes)]
            self.offsets = np.concatenate([[0], np.cumsum(np.where(self.is_copy, 0, self.sizes))])

    def stretches(self, length: int, gram: int) -> Stretches:
        return Stretches.of(self.data, self.offsets, self.hits, length, gram, self.heavy)


def whole_characters(gone: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The bytes of the UTF-8 characters that are gone in all their bytes."""
    if not len(data):
        return gone
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return (np.bincount(np.maximum(character, 0), ~gone) == 0)[np.maximum(character, 0)]


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    characters: bool = False,
    anchor_windows: int = ANCHOR_WINDOWS,
) -> DataFrame:
    """All columns but the text, and ``n_bytes``, ``removed`` and ``kept``.

    Every byte that is covered by a string of ``length`` bytes which also starts
    in a row with a smaller id goes. ``removed`` are the maximal runs of such
    bytes, as sorted byte ranges (end not included), ``kept`` the other bytes.
    Texts are UTF-8 bytes, null is empty; a run may end inside a character, so
    ``kept`` is binary. With ``characters`` a character stays unless all its
    bytes go, and ``kept`` is UTF-8 again. Texts shorter than ``length`` stay
    whole. Ids must be integers; rows of one id are equally small and take
    nothing from each other; rows with a null id neither take nor lose
    anything. Columns with the names of the new ones are replaced. An anchor
    with more than about ``anchor_windows`` different windows is divided by
    window; this changes no result.
    """
    if not 1 <= gram <= length:
        raise ValueError("a string must hold at least one gram")
    others = [c for c in df.columns if c not in (text_col, "n_bytes", "removed", "kept")]
    hidden = [f"c{i}" for i in range(len(others))]
    all_texts = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *(df[c].alias(h) for c, h in zip(others, hidden, strict=True)),
    )
    texts = all_texts.where("id IS NOT NULL")
    blocks, shards = blocks_and_shards(texts, "text", block_bytes, SHARD_BYTES)
    keys = texts.where(F.octet_length("text") >= length).select("id", F.unhex(F.md5("text")).alias("key"))
    copies = copies_by_block(keys, blocks)
    docs = texts.select("*", block_of("id", blocks))
    by_block = docs.groupBy("block")

    def anchors(docs: pa.Table, table: pa.Table) -> pa.Table:
        block = Block(docs, table)
        found = []
        for a, b in slices(block.offsets):
            base = block.offsets[a]
            values = window_anchors(block.data[base : block.offsets[b]], block.offsets[a : b + 1] - base, length, gram)
            edge = np.ones(len(values), bool)
            edge[1:] = values[1:] != values[:-1]
            edge[(block.offsets[a:b] - base)[block.offsets[a:b] < block.offsets[b]]] = True
            at = np.flatnonzero(edge & (values != _NONE))
            row = np.searchsorted(block.offsets, at + base, "right") - 1
            windows = np.diff(np.append(np.flatnonzero(edge), len(values)))[np.searchsorted(np.flatnonzero(edge), at)]
            content = span_hashes(block.data[base : block.offsets[b]], at, at + windows + length - 1, LONGEST_PLAIN)
            found.append(np.stack([values[at], block.ids[row].view(np.uint64), windows.astype(np.uint64), content]))
        values, ids, windows, content = np.concatenate([np.zeros((4, 0), np.uint64), *found], axis=1)
        # Equal stretches of a block are sent once.
        weights = np.zeros(len(values), np.int64)
        _, once = np.unique(content, return_index=True)
        weights[once] = windows[once]
        out = shard_notes(values, ids, docs.column("block")[0].as_py() if docs.num_rows else -1, shards, weights)
        return release(out)

    def repeated(table: pa.Table) -> pa.Table:
        return repeated_notes(table, anchor_windows)

    hits = (
        by_block.cogroup(copies.groupBy("block"))
        .applyInArrow(anchors, NOTES)
        .groupBy("block")
        .applyInArrow(repeated, NOTES)
    )
    known = hits.unionByName(copies)

    def stretches(docs: pa.Table, table: pa.Table) -> pa.Table:
        block = Block(docs, table)
        s = block.stretches(length, gram)
        rows = []
        if len(s.first):
            number = docs.column("block")[0].as_py()
            lowest = np.full(len(s.first), np.iinfo(np.int64).max)
            np.minimum.at(lowest, s.number, block.ids[s.rows])
            shard = (s.anchors[s.first] % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            sizes = (s.ends - s.starts)[s.first]
            anchors = s.anchors[s.first].view(np.int64)
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                text = b"".join(block.data[s.starts[i] : s.ends[i]].tobytes() for i in s.first[part].tolist())
                meta = np.stack([np.full(len(part), number), part, sizes[part], lowest[part], anchors[part]])
                rows.append((int(shard[part[0]]), "text", text, meta.astype(np.int64).tobytes(), b""))
        return release(notes(rows))

    def repeats(table: pa.Table) -> pa.Table:
        texts = [np.frombuffer(v, np.uint8) for v in table.column("first").to_pylist()]
        parts = [numbers(v).reshape(5, -1) for v in table.column("second").to_pylist()]
        data = np.concatenate([np.zeros(0, np.uint8), *texts])
        block, number, sizes, owner, anchor = np.concatenate([np.zeros((5, 0), np.int64), *parts], axis=1)
        begins = np.cumsum(sizes) - sizes
        marked = [np.zeros((4, 0), np.int64)]
        # Equal strings have one anchor, or one window hash if it is heavy, so a shard is searched in portions of these.
        order = np.argsort(anchor, kind="stable")
        done = np.cumsum(sizes[order])
        ends = np.append(np.flatnonzero(np.diff(anchor[order])) + 1, len(order)) if len(order) else order
        first = 0
        while first < len(order):
            wanted = (done[first - 1] if first else 0) + PORTION_BYTES
            fitting = ends[(ends > first) & (done[ends - 1] <= wanted)]
            last = int(fitting[-1]) if len(fitting) else int(ends[ends > first][0])
            own = order[first:last]
            strings = b"".join(data[begins[i] : begins[i] + sizes[i]].tobytes() for i in own.tolist())
            which, offset, size = marks_in_shard(strings, sizes[own], owner[own], length)
            marked.append(np.stack([block[own][which], number[own][which], offset, size]))
            first = last
        marked = np.concatenate(marked, axis=1)
        marked = marked[:, np.argsort(marked[0], kind="stable")]
        rows = []
        for part in np.split(marked, np.flatnonzero(np.diff(marked[0])) + 1, axis=1) if marked.size else []:
            rows.append((int(part[0, 0]), "marks", np.ascontiguousarray(part[1:]).tobytes(), b"", b""))
        return release(notes(rows))

    marks = (
        by_block.cogroup(known.groupBy("block"))
        .applyInArrow(stretches, NOTES)
        .groupBy("block")
        .applyInArrow(repeats, NOTES)
    )
    everything = known.unionByName(marks)

    def judge(docs: pa.Table, table: pa.Table) -> pa.Table:
        block = Block(docs, table)
        s = block.stretches(length, gram)
        cover = np.zeros(len(block.data) + 1, np.int32)
        lowest = np.full(len(s.first), np.iinfo(np.int64).max)
        np.minimum.at(lowest, s.number, block.ids[s.rows])
        # A later row with the same stretch, and what the shards have marked.
        later = block.ids[s.rows] > lowest[s.number] if len(s.number) else np.zeros(0, bool)
        np.add.at(cover, s.starts[later], 1)
        np.add.at(cover, s.ends[later], -1)
        by_number = np.argsort(s.number, kind="stable")
        places = np.searchsorted(s.number[by_number], np.arange(len(s.first) + 1))
        for value, _, _ in of_kind(table, "marks"):
            number, offset, size = numbers(value).reshape(3, -1)
            counts = places[number + 1] - places[number]
            at = np.repeat(places[number] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            starts = s.starts[by_number[at]] + np.repeat(offset, counts)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + np.repeat(size, counts), -1)
        gone = np.cumsum(cover, out=cover)[:-1] > 0
        del s, cover, by_number
        if characters:
            gone = whole_characters(gone, block.data)
        removed, kept = [], []
        for i in range(len(block.ids)):
            if block.is_copy[i]:
                removed.append([{"first": 0, "last": int(block.sizes[i])}])
                kept.append(b"")
                continue
            a, b = block.offsets[i], block.offsets[i + 1]
            here = gone[a:b]
            step = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).astype(np.int8)))
            removed.append([{"first": int(x), "last": int(y)} for x, y in step.reshape(-1, 2)])
            kept.append(block.data[a:b][~here].tobytes() if len(step) else block.data[a:b].tobytes())
        spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        out = pa.table(
            [
                *(block.docs.column(h) for h in hidden), pa.array(block.sizes.astype(np.int64)),
                pa.array(removed, spans), pa.array(kept, pa.binary()),
            ],
            [*hidden, "n_bytes", "removed", "kept"],
        )
        return release(out)

    spans = T.DataType.fromDDL("array<struct<first:long,last:long>>")
    schema = T.StructType([
        *(all_texts.schema[h] for h in hidden),
        T.StructField("n_bytes", T.LongType()), T.StructField("removed", spans), T.StructField("kept", T.BinaryType()),
    ])
    out = by_block.cogroup(everything.groupBy("block")).applyInArrow(judge, schema)
    alone = all_texts.where("id IS NULL").select(
        *hidden,
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast(spans).alias("removed"),
        F.col("text").cast("binary").alias("kept"),
    )
    return out.unionByName(alone).withColumnsRenamed(dict(zip(hidden, others, strict=True)))
