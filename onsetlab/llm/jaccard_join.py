"""Documents linked by the Jaccard similarity of their word shingles.

The method is a rare-first prefix join. Blocks of documents tell shards of the
hash space which shingles they hold, and learn which of theirs other documents
hold too and how many blocks know them. In the order of this count (then by
hash) a pair that is similar enough shares one of the first, rarest shingles of
both. A shingle of one document only shares nothing: it takes its place in the
order and is then forgotten. Sets that are equal are one set from the start.

Sets that share a prefix shingle meet in the cell that is named by the smallest
of them. In a cell the pairs are found through an index over the prefixes,
filtered by length, by the positions of the shared shingle, by a count signature
over the rest of the set, and the remaining ones are verified exactly. Only
links are wanted, so a pair that verified links already join is not looked at
again: a group of thousands of near copies costs a few passes, not all pairs.

A large cell is dealt into blocks with a few common anchors, which join most of
it. Then every set outside the largest component of its cell is compared with
all blocks of the cell, so no link is lost whatever the size.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onsetlab.llm.blocks import (
    NOTES,
    block_of,
    blocks_and_shards,
    copies_by_block,
    copies_in,
    hits_in,
    pack,
    repeated_notes,
    shard_notes,
    unpack,
)
from onsetlab.llm.buffers import gram_hashes, release, slices, span_hashes, utf8, word_spans
from onsetlab.llm.components import components
from onsetlab.llm.quality import LOWER
from onsetlab.llm.scratch import cut

SHINGLE_WORDS = 5
SIMILAR = (75, 100)
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
CELL_ROWS = 1024
ANCHORS = 16
SIGNATURE = 32
LINKS = "a long, b long"


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted different shingle hashes of each text; empty without words."""
    codes = LOWER[data]
    starts, ends, rows = word_spans(codes != 0, offsets)
    words = span_hashes(codes, starts, ends)
    grams = gram_hashes(words, size)
    cuts = np.searchsorted(rows, np.arange(len(offsets)))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        n = b - a
        if n >= size:
            yield np.unique(grams[a : b - size + 1])
        else:
            yield gram_hashes(words[a:b], n) + np.uint64(n) if n else np.zeros(0, np.uint64)


def batched(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    data, offsets = utf8(column)
    for a, b in slices(offsets):
        yield from shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)


def prefix_length(n: np.ndarray | int, similar: tuple[int, int]) -> np.ndarray | int:
    num, den = similar
    return n - -(-num * n // den) + 1


def needed_overlap(n: np.ndarray | int, m: np.ndarray | int, similar: tuple[int, int]) -> np.ndarray | int:
    num, den = similar
    return -(-num * (n + m) // (num + den))


class Cell:
    """Sets side by side with an index over their prefixes.

    A set is the rare-first list of its shingles that other documents hold, and
    its full size: the shingles of no other document come before all of them.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, similar: tuple[int, int]):
        self.similar, self.sets, self.n = similar, sets, sizes
        self.held = np.array([len(s) for s in sets], np.int64)
        self.alone = sizes - self.held
        heads = [self.head(i) for i in range(len(sets))]
        lengths = np.array([len(h) for h in heads], np.int64)
        tokens = np.concatenate(heads)
        owner = np.repeat(np.arange(len(sets)), lengths)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + self.alone[owner]
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner, self.place = tokens[order], owner[order], place[order]
        self.signatures = np.stack([signature(s) for s in sets])

    def head(self, i: int) -> np.ndarray:
        return self.sets[i][: max(0, prefix_length(self.n[i], self.similar) - self.alone[i])]

    def similar_to(self, i: int, wanted: np.ndarray) -> np.ndarray:
        """The sets among ``wanted`` (a mask) that are similar enough to set ``i``."""
        head, n, alone = self.head(i), self.n[i], self.alone[i]
        first, last = np.searchsorted(self.tokens, head, "left"), np.searchsorted(self.tokens, head, "right")
        counts = last - first
        total = int(counts.sum())
        if not total:
            return np.zeros(0, np.int64)
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(total)
        here = np.repeat(np.arange(len(head)) + alone, counts)
        owner = self.owner[at]
        keep = wanted[owner]
        owner, here, there = owner[keep], here[keep], self.place[at[keep]]
        # The first shared shingle of each set; those before it are not shared.
        owner, which = np.unique(owner, return_index=True)
        here, there = here[which], there[which]
        m = self.n[owner]
        need = needed_overlap(m, n, self.similar)
        num, den = self.similar
        good = (num * np.maximum(m, n) <= den * np.minimum(m, n)) & (np.minimum(m - there, n - here) >= need)
        owner, need = owner[good], need[good]
        good = np.minimum(self.signatures[owner], self.signatures[i]).sum(1) >= need
        owner, need = owner[good], need[good]
        if not len(owner):
            return owner
        mine = np.sort(self.sets[i])
        joined = np.concatenate([self.sets[j] for j in owner])
        at = np.minimum(np.searchsorted(mine, joined), len(mine) - 1)
        cuts = np.concatenate([[0], np.cumsum(self.held[owner])[:-1]])
        return owner[np.add.reduceat((mine[at] == joined).astype(np.int64), cuts) >= need]


def signature(s: np.ndarray) -> np.ndarray:
    """How many shingles fall into each part of the hash space."""
    return np.bincount((s & np.uint64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE).astype(np.int32)


class Groups:
    """Union-find over small numbers, with the size of each group."""

    def __init__(self, labels: np.ndarray):
        _, self.label = np.unique(labels, return_inverse=True)

    def join(self, members: np.ndarray) -> None:
        groups = np.unique(self.label[members])
        self.label[np.isin(self.label, groups)] = groups[0]


def groups_in_cell(cell: Cell) -> np.ndarray:
    """For each set the first set of its group, by verified links within the cell.

    Pairs that links already join are skipped.
    """
    groups = Groups(np.arange(len(cell.sets)))
    undone = np.ones(len(cell.sets), bool)
    while True:
        left = np.flatnonzero(undone)
        names, sizes = np.unique(groups.label[left], return_counts=True)
        if len(names) < 2:
            break
        # Sets of the largest group need not ask: the others ask for them.
        asked = int(left[groups.label[left] != names[np.argmax(sizes)]][0])
        undone[asked] = False
        found = cell.similar_to(asked, undone & (groups.label != groups.label[asked]))
        groups.join(np.append(found, asked))
    _, first, which = np.unique(groups.label, return_index=True, return_inverse=True)
    return first[which]


def cell_of(rows: pd.DataFrame, similar: tuple[int, int]) -> Cell:
    return Cell([np.frombuffer(t, np.uint64) for t in rows["tokens"]], rows["n"].to_numpy(), similar)


def link_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    similar: tuple[int, int] = SIMILAR,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable).

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
    A text of fewer words than a shingle is one shingle; a null or empty text or
    one without words has none and is linked with nothing. Two documents are
    linked if ``den * intersection >= num * union`` for ``similar = (num, den)``.
    Rows that repeat an id are one document: what one of them is linked with,
    all are. A row with a null id is linked with nothing and has no component.
    Ids must be integers. Shingles are compared by 48 bits of their hash, equal
    sets by 128. Other columns are not read.
    """
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys = [], []
            for found in batched(batch.column(1), shingle_words):
                n.append(len(found))
                keys.append(blake2b(found.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary())], ["id", "n", "key"]
            )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, tokens = [], [], []
            for found in batched(batch.column(1), shingle_words):
                n.append(len(found))
                keys.append(blake2b(found.tobytes(), digest_size=16).digest())
                tokens.append(pack(found >> np.uint64(16)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())],
                ["id", "n", "key", "tokens"],
            )

    described = cut(texts.mapInArrow(describe, "id long, n long, key binary"))
    some = described.where("id IS NOT NULL AND n > 0")
    blocks, shards = blocks_and_shards(texts, "text", BLOCK_BYTES, SHARD_BYTES)
    copies = copies_by_block(some.select("id", "key"), blocks)
    by_block = (
        texts.where("id IS NOT NULL")
        .mapInArrow(gather, "id long, n long, key binary, tokens binary")
        .where("n > 0")
        .select("id", "n", "key", "tokens", block_of("id", blocks))
        .groupBy("block")
    )

    def hold(docs: pa.Table, table: pa.Table) -> pa.Table:
        ids, _, sets = _without_copies(docs, table)
        values = np.concatenate([np.zeros(0, np.uint64), *sets])
        owner = np.repeat(ids, [len(s) for s in sets])
        return release(shard_notes(values, owner, docs.column("block")[0].as_py() if docs.num_rows else -1, shards))

    def order(docs: pa.Table, table: pa.Table) -> pa.Table:
        ids, sizes, sets = _without_copies(docs, table)
        hits, levels = hits_in(table)
        kept: tuple[list, list, list, list] = ([], [], [], [])
        for own, n, s in zip(ids.tolist(), sizes.tolist(), sets, strict=True):
            at = np.minimum(np.searchsorted(hits, s), max(len(hits) - 1, 0))
            known = hits[at] == s if len(hits) else np.zeros(len(s), bool)
            # By level, then by hash; shingles of this set alone would come first.
            held = np.sort((levels[at[known]].astype(np.uint64) << np.uint64(48)) | s[known])
            head = held[: max(0, prefix_length(n, similar) - (n - len(held)))]
            if len(head):
                for column, value in zip(kept, (own, n, head.astype(np.int64), held.tobytes()), strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        return release(pa.table([pa.array(c, k) for c, k in zip(kept, kinds, strict=True)], ["id", "n", "head", "tokens"]))

    hits = (
        by_block.cogroup(copies.groupBy("block"))
        .applyInArrow(hold, NOTES)
        .groupBy("block")
        .applyInArrow(lambda table: release(repeated_notes(table)), NOTES)
    )
    sets = cut(
        by_block.cogroup(hits.unionByName(copies).groupBy("block")).applyInArrow(
            order, "id long, n long, head array<long>, tokens binary"
        )
    )
    whole = Window.partitionBy("token")
    met = (
        sets.select("id", F.explode("head").alias("token"))
        .select("id", F.count("*").over(whole).alias("sets"), F.min("id").over(whole).alias("cell"))
        .where("sets > 1")
    )
    cells = cut(met.select("id", "cell").distinct())
    size = cells.groupBy("cell").agg(F.count("*").alias("rows"))
    parts = F.ceil(F.col("rows") / cell_rows).cast("int")
    place = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    anchor = F.pmod(F.xxhash64("id", F.lit(1)), F.col("rows")) < ANCHORS
    dealt = cut(
        cells.join(size, "cell")
        .withColumn("blocks", parts)
        .withColumn("block", place)
        .select("id", "cell", "blocks", "block", (anchor & (F.col("blocks") > 1)).alias("anchor"))
    )
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    seats = dealt.withColumn("seat", F.explode(F.when(F.col("anchor"), every).otherwise(F.array("block"))))

    def seated(places: DataFrame) -> DataFrame:
        """Places (columns ``id`` and more) with the sets of their documents."""
        return sets.select("id", "n", "tokens").join(places, "id")

    def local(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        ids = rows["id"].to_numpy()
        # A group is a star around its smallest id, the same in whatever cell it is met.
        links = pd.DataFrame({"a": ids, "b": ids[groups_in_cell(cell_of(rows, similar))]})
        return links[links["a"] != links["b"]]

    # Rows of one id are one document, whatever their sets: the id joins the smallest ids that have these.
    several = some.groupBy("id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("id")
    firsts = some.groupBy("key").agg(F.min("id").alias("b"))
    bridges = some.join(several, "id").join(firsts, "key").where("id <> b").select(F.col("id").alias("a"), "b")
    links = cut(
        seated(seats.select("id", "cell", "seat"))
        .groupBy("cell", "seat")
        .applyInPandas(local, LINKS)
        .union(bridges)
        .distinct()
    )
    named = components(links)
    if dealt.where("blocks > 1").limit(1).count():
        found = _between_blocks(dealt, named, seated, similar, cell_rows)
        named = components(links.union(found))
    classes = (
        some.groupBy("key").agg(F.min("id").alias("first"))
        .join(named.select(F.col("node").alias("first"), "component"), "first", "left")
        .select("key", F.coalesce("component", "first").alias("smallest"))
    )
    return (
        described.join(classes, "key", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("smallest")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def _without_copies(docs: pa.Table, table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    ids, sizes = docs.column("id").to_numpy(), docs.column("n").to_numpy()
    keys = docs.column("key")
    own = np.flatnonzero(~copies_in(table, ids, lambda i: keys[i].as_py()))
    tokens = docs.column("tokens")
    return ids[own], sizes[own], [np.unique(unpack(tokens[i].as_py())) for i in own.tolist()]


def _between_blocks(dealt, named, seated, similar, cell_rows) -> DataFrame:
    """Links of the sets that are not in the largest component of a large cell."""
    large = dealt.where("blocks > 1").join(named.withColumnRenamed("node", "id"), "id", "left")
    large = cut(large.withColumn("component", F.coalesce("component", "id")))
    most = (
        large.groupBy("cell", "component")
        .agg(F.count("*").alias("rows"))
        .groupBy("cell")
        .agg(F.max_by("component", F.struct("rows", "component")).alias("largest"))
    )
    outside = large.join(most, "cell").where("component <> largest")
    askers = outside.withColumn("seat", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Askers come in portions of bounded size, each of which meets every block.
    portions = (
        outside.groupBy("cell").agg(F.count("*").alias("asked"))
        .withColumn("portions", F.ceil(F.col("asked") / cell_rows).cast("int"))
    )
    askers = askers.join(portions, "cell").withColumn(
        "portion", F.pmod(F.xxhash64("id", F.lit(2)), F.col("portions")).cast("int")
    )
    blocks = (
        large.join(portions, "cell")
        .withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))
        .withColumn("seat", F.col("block"))
    )
    fields = ["id", "cell", "seat", "portion", "component"]
    places = blocks.select(*fields, F.lit(False).alias("asks")).union(askers.select(*fields, F.lit(True)))

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["asks", "id"], kind="stable")
        ids, asks = rows["id"].to_numpy(), rows["asks"].to_numpy()
        links: list[tuple] = []
        if asks.any() and not asks.all():
            groups, cell = Groups(rows["component"].to_numpy()), cell_of(rows, similar)
            for asked in np.flatnonzero(asks).tolist():
                found = cell.similar_to(asked, ~asks & (groups.label != groups.label[asked]))
                _, one = np.unique(groups.label[found], return_index=True)  # one link to each group
                links += [(ids[asked], ids[j]) for j in found[one]]
                groups.join(np.append(found, asked))
        return pd.DataFrame(links, columns=["a", "b"])

    return seated(places).groupBy("cell", "seat", "portion").applyInPandas(across, LINKS)
