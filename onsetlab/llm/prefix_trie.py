"""The trie of all conversation prefixes, as node tables with perfect hashing.

A prefix is named by a chained digest of its turns. Each shard numbers the
distinct digests it holds with a minimal perfect hash, checks every slot
against the whole digest, scatters what its nodes weigh into flat arrays and
adds them up through the slots of the parents, deepest first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onsetlab.llm.buffers import mix
from onsetlab.llm.scratch import cut
from onsetlab.operators.lookup import lookup_join

DIGEST_BYTES = 16
ROOT = bytes(DIGEST_BYTES)
#: Rows of paths that a shard should hold.
SHARD_ROWS = 1 << 18
LEAST_SHARDS = 16
#: Turns of one conversation that a shard holds at most; longer ones are cut into stretches.
STRETCH = 4096
_ABSENT = -1


class PerfectHash:
    """A minimal perfect hash of distinct 16-byte digests.

    Level by level the keys still left are hashed into a bit array with room
    for more than there are; a key alone in its place stays there, the others go
    one level down. The slot of a key is the number of set bits before its own.
    """

    ROOM = 2.0

    def __init__(self, digests: np.ndarray):
        """``digests`` is (n, 2) of unsigned 64-bit halves, all rows different."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.digests = np.zeros_like(digests)
        left, before = digests, 0
        while len(left):
            size = int(len(left) * self.ROOM) + 1
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            rank = np.cumsum(alone) - alone + before
            stays = alone[place]
            self.levels.append((alone, rank))
            self.digests[rank[place[stays]]] = left[stays]
            before += int(stays.sum())
            left = left[~stays]

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
        return (mix(mix(digests[:, 0] ^ seed) ^ digests[:, 1]) % np.uint64(size)).astype(np.int64)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for one that is not in the table."""
        out = np.full(len(digests), _ABSENT)
        left = np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(digests[left], level, len(alone))
            here = alone[place]
            out[left[here]] = rank[place[here]]
            left = left[~here]
        # Any digest finds a slot; only its own holds the whole of it.
        found = out >= 0
        found[found] = (self.digests[out[found]] == digests[found]).all(axis=1)
        return np.where(found, out, _ABSENT)


def halves(digests: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 2)


def distinct(digests: np.ndarray) -> np.ndarray:
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    return digests[order][np.append(True, (np.diff(digests[order].view(np.int64), axis=0) != 0).any(axis=1))[: len(order)]]


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """A digest of role and text (null: empty) in which their border counts."""
    role_text, own = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role_text).cast("string"), F.lit(":"), role_text, own), 256)), 1, DIGEST_BYTES)


PATHS = "conv_id long, depth long, digest binary, parent binary, bytes long, ends boolean"


def shared_starts(turns: DataFrame, span: int = 5, most: int = 9) -> DataFrame:
    """Rebuilt conversations as rows PATHS: one per prefix, the empty one (depth 0) included.

    Conversation c gets the first h turns of conversation c - c % ``span``, then
    its own after its first h, where h is crc32 of c in decimal modulo ``most``.
    Turns are ordered by number, null first, those of one number by the digest
    of role and text; equal rows are turns each. Conversations without an id
    take no part.

    One shuffle of digests: the conversations that share a start are sorted into
    one stream, of which a task holds the first turns of one conversation.
    """
    first = F.col("conv_id") - F.col("conv_id") % span
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        turn_digest().alias("own"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"),
    )
    keyed = narrow.select(
        first.alias("start"), "*", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int").alias("h")
    )
    by_turn = ["start", F.col("conv_id") != F.col("start"), "conv_id", F.col("turn").asc_nulls_first(), "own"]
    ordered = keyed.repartition("start").sortWithinPartitions(*by_turn).select("start", "conv_id", "own", "bytes", "h")
    return ordered.mapInArrow(lambda batches: _walk(batches, most - 1), PATHS)


def _walk(batches: Iterable[pa.RecordBatch], most_lead: int) -> Iterator[pa.RecordBatch]:
    start = conv = None
    lead: list[tuple[bytes, int]] = []  # the first turns of the conversation that others start with
    own_turns = depth = 0
    digest = ROOT
    out: list[list] = [[] for _ in range(6)]

    def put(parent: bytes, size: int) -> None:
        for column, value in zip(out, (conv, depth, digest, parent, size, False), strict=True):
            column.append(value)

    def step(turn: bytes, size: int) -> None:
        nonlocal digest, depth
        parent, depth = digest, depth + 1
        digest = hashlib.blake2b(parent + turn, digest_size=DIGEST_BYTES).digest()
        put(parent, size)

    def begin(wanted: int) -> None:
        nonlocal digest, depth
        digest, depth = ROOT, 0
        put(ROOT, 0)
        for turn, size in lead[:wanted] if conv != start else ():
            step(turn, size)

    def flush(rows: int) -> pa.RecordBatch:
        """The first rows so far; the last of all waits to be told whether it is an end."""
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c[:rows], k) for c, k in zip(out, kinds, strict=True)], [c.split()[0] for c in PATHS.split(", ")]
        )
        for column in out:
            del column[:rows]
        return batch

    for batch in batches:
        for own_start, own_conv, turn, size, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own_conv != conv:
                if out[5]:
                    out[5][-1] = True
                if own_start != start:
                    start, lead = own_start, []
                conv, own_turns = own_conv, 0
                begin(h)
            own_turns += 1
            if conv == start:
                if len(lead) < most_lead:
                    lead.append((turn, size))
                step(turn, size)
            elif own_turns > h:
                step(turn, size)
        if len(out[0]) > 1:
            yield flush(len(out[0]) - 1)
    if out[5]:
        out[5][-1] = True
        yield flush(len(out[0]))


def _joined_ids(ends: DataFrame) -> DataFrame:
    """``digest, ends_sha256``: SHA-256 of the rising ids with one digest, streamed in their order."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for digest, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest != node:
                    if node is not None:
                        done.append((node, running.hexdigest()))
                    node, running = digest, hashlib.sha256(str(conv).encode())
                else:
                    running.update(b"," + str(conv).encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(_columns(done, 2), (pa.binary(), pa.string()), strict=True)], ["digest", "ends_sha256"])
            done = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], ["digest", "ends_sha256"])

    ordered = ends.select("digest", "conv_id").repartition("digest").sortWithinPartitions("digest", "conv_id")
    return ordered.mapInArrow(walk, "digest binary, ends_sha256 string")


def _columns(rows: list[tuple], width: int) -> list[list]:
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(width)]


def _accumulate(paths: pa.Table, nodes: pa.Table, stretch: int) -> pa.Table:
    """Sums over the subtrees of all nodes on the paths, of what the shard's own nodes weigh."""
    digests, parents, depth = halves(paths.column("digest")), halves(paths.column("parent")), paths.column("depth").to_numpy()
    table = PerfectHash(distinct(digests))
    slot = table.slots(digests)
    n = len(table.digests)
    # The top of a stretch adds nothing to what is above it here, but passes its sum on later.
    parent, level = np.full(n, _ABSENT), np.zeros(n, np.int64)
    parent[slot] = np.where(depth % stretch, table.slots(parents), _ABSENT)
    level[slot] = depth
    leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64)
    own = table.slots(halves(nodes.column("digest")))
    leaves[own] = nodes.column("n_children").to_numpy() == 0
    saved[own] = nodes.column("saved").to_numpy()
    order = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    for at in np.split(order, cuts):
        up = parent[at]
        at, up = at[up >= 0], up[up >= 0]
        np.add.at(leaves, up, leaves[at])
        np.add.at(saved, up, saved[at])
    met = np.flatnonzero((leaves != 0) | (saved != 0))
    names = [r.tobytes() for r in table.digests[met]]
    return pa.table([pa.array(names, pa.binary()), pa.array(leaves[met]), pa.array(saved[met])], ["digest", "n_leaves", "saved_tokens"])


def prefix_trie(
    turns: DataFrame, rebuild: Callable[[DataFrame], DataFrame] = shared_starts, stretch: int = STRETCH
) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` per node.

    A node is a distinct prefix of the conversations that ``rebuild`` gives as
    rows PATHS; its members are the conversations that begin with it, and
    ``conv_id`` the smallest of them. ``n_leaves`` counts the childless nodes of
    its subtree, itself included; ``saved_tokens`` sums, over the subtree, the
    bytes of each node's last text times its members but one; ``ends_sha256``
    is the digest of the ids, rising and joined by commas, that end with it.
    A table without conversations gives no rows, not even a root.

    A node belongs to the shard of its smallest member, where the path of that
    conversation holds all its ancestors: each shard sums what its own nodes
    weigh into these, and the sums of a node from all shards are added. So a
    prefix that very many conversations share weighs one row a shard. A
    conversation of more than ``stretch`` turns is cut into stretches, whose sums
    are passed on to all that is above them.
    """
    paths = cut(rebuild(turns))
    members = paths.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.min("bytes").alias("bytes"),
    )
    members = cut(members)
    children = members.where("depth > 0").groupBy(F.col("parent").alias("digest")).agg(F.count("*").alias("n_children"))
    nodes = cut(
        members.join(children, "digest", "left")
        .fillna(0, ["n_children"])
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    )
    sums = _subtree_sums(paths, nodes, stretch)
    ends = _joined_ids(paths.where("ends"))
    parents = nodes.where("n_children > 0").select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = lookup_join(nodes.where("depth > 0"), parents, "parent", "left", spread=["digest"])
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        below.unionByName(root)
        .join(sums, "digest")
        .join(ends, "digest", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def _subtree_sums(paths: DataFrame, nodes: DataFrame, stretch: int) -> DataFrame:
    shards = max(LEAST_SHARDS, -(-paths.count() // SHARD_ROWS))
    part = F.floor(F.col("depth") / stretch).alias("part")

    def dealt(frame: DataFrame, shard: str) -> DataFrame:
        return frame.withColumn(shard, F.pmod(F.xxhash64("conv_id", part), F.lit(shards)).cast("int"))

    # Conversations that are the smallest member of no node have nothing to add.
    needed = paths.join(nodes.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "depth", "digest", "parent")
    # Renamed, or both sides of the cogroup would have the same columns by descent.
    own = dealt(nodes.select([F.col(c).alias(c) for c in ("conv_id", "depth", "digest", "n_children", "saved")]), "of")
    added = (
        dealt(needed, "shard")
        .groupBy("shard")
        .cogroup(own.groupBy("of"))
        .applyInArrow(lambda a, b: _accumulate(a, b, stretch), "digest binary, n_leaves long, saved_tokens long")
    )
    totals = [F.sum(name).cast("long").alias(name) for name in ("n_leaves", "saved_tokens")]
    if not paths.where(F.col("depth") >= stretch).isEmpty():
        added = cut(added)
        tops = nodes.where((F.col("depth") > 0) & (F.col("depth") % stretch == 0)).select("conv_id", "digest", part)
        # What the stretches below pass on to each stretch of the conversation above them.
        passed = (
            tops.join(added.groupBy("digest").agg(*totals), "digest")
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part") - 1)))
            .groupBy("conv_id", "part")
            .agg(*totals)
        )
        above = needed.withColumn("part", part).join(passed, ["conv_id", "part"])
        added = added.unionByName(above.select("digest", "n_leaves", "saved_tokens"))
    return added.groupBy("digest").agg(*totals)
