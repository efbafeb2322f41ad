"""Fingerprints, hard negatives and the prefix trie against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from onsetlab.llm import fingerprints, hard_negatives, prefix_trie


# Fingerprints ------------------------------------------------------------------------------------


def brute_digest(text: str) -> list[int]:
    """Length code and bucket codes, byte by byte."""
    data = text.encode()
    counts = [0] * 256
    for i in range(len(data)):
        byte = lambda j: data[j] if j < len(data) else 0
        for kind, (near, far) in enumerate(((6, 12), (7, 17), (5, 13))):
            h = data[i] * 0x9E3779B1 + byte(i + near) * 0x85EBCA6B + byte(i + far) * 0xC2B2AE35 + kind * 0x27D4EB2F
            h %= 1 << 32
            h = (h ^ h >> 15) * 0x2C1B3C6D % (1 << 32)
            counts[(h >> 12) % 256] += 1
    cuts = [sorted(counts)[64 * q - 1] for q in (1, 2, 3)]
    return [min(255, round(math.log(1 + len(data)) / math.log(1.1))), *(sum(c > q for q in cuts) for c in counts)]


def brute_likeness(one: list[int], other: list[int]) -> float:
    difference = sum(abs(a - b) for a, b in zip(one[1:], other[1:], strict=True)) + 2 * min(32, abs(one[0] - other[0]))
    return 1 - min(difference, 320) / 320


def awkward_docs() -> list[tuple]:
    source = random.Random(11)
    words = ["the", "thing", "Über", "日本", "😀", "a", "x1", "and,", "don't"]
    texts = [" ".join(source.choices(words, k=source.randint(0, 30))) for _ in range(40)]
    texts += [None, "", "a", "ab", "日", "a" * 5000, " ".join(source.choices(words, k=9000)), texts[0], texts[0]]
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    return rows + [(3, texts[3], "z", "z", 2), (3, "other text of id 3", "z", "z", 2), (None, "no id", None, None, None)]


DOC_SCHEMA = "doc_id long, text string, part string, kind string, n_chars long"


def test_fingerprints_and_edits(spark):
    rows = awkward_docs()
    got = fingerprints.compare_with_next(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)).collect()
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)
    ordered = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    expected = Counter()
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        part = len(text) // 3
        edited = text[: len(text) - part] + after[:part]
        own, other, next_one = map(brute_digest, (text, edited, after))
        near = round(brute_likeness(own, other), 9), round(brute_likeness(own, next_one), 9)
        expected[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(own), str(other), *near)] += 1
    codes = lambda digest: str(fingerprints.as_codes([digest])[0].tolist())
    assert expected == Counter(
        (r["doc_id"], r["n_chars"], r["edited_sha256"], codes(r["fingerprint"]), codes(r["edited_fingerprint"]),
         round(r["near_edited"], 9), round(r["near_next"], 9))
        for r in got
    )


def test_fingerprints_of_one_row_and_of_none(spark):
    one = fingerprints.compare_with_next(spark.createDataFrame([(1, "abcdef", "", "", 0)], DOC_SCHEMA)).collect()
    assert [(r["near_next"], r["edited_sha256"]) for r in one] == [(1.0, hashlib.sha256(b"abcdab").hexdigest())]
    assert fingerprints.compare_with_next(spark.createDataFrame([], DOC_SCHEMA)).collect() == []


def test_fingerprint_columns(spark):
    docs = spark.createDataFrame([("abc def", "abc def"), ("abc def", None), (None, "")], "a string, b string")
    both = docs.select(fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b"))
    near = [r[0] for r in both.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()]
    assert near[0] == near[2] == 1.0 and 0 <= near[1] < 1
    missing = both.select(fingerprints.likeness(F.col("a"), F.lit(None).cast("string")))
    assert [r[0] for r in missing.collect()] == [None] * 3


def test_slices_do_not_change_digests():
    texts = [("word%d " % i * (i % 7)).encode() for i in range(5000)] + [b"z" * (3 << 20)]
    whole = fingerprints.codes_of(texts)
    assert (whole[::977] == np.concatenate([fingerprints.codes_of([t]) for t in texts[::977]])).all()


# Hard negatives ----------------------------------------------------------------------------------


def test_hilbert_keys_visit_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = [k.tobytes() for k in hard_negatives.hilbert_keys(cells, 3)]
    assert len(set(keys)) == side**3
    path = cells[np.argsort(np.array(keys, dtype=object))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_all_products():
    source = np.random.default_rng(3)
    rows, asked = source.integers(-50, 50, (40, 6)), source.integers(-50, 50, (9, 6))
    least, most = hard_negatives.bounds(asked, rows.min(axis=0)[None], rows.max(axis=0)[None])
    products = asked @ rows.T
    assert (products >= least).all() and (products <= most).all()


EMBEDDING_SCHEMA = "vec_id long, embedding array<float>, label int, block int, ask string, rank int"


def brute_negatives(rows: list[tuple], every: int, scale: int, window: tuple[int, int]) -> Counter:
    usable = []
    for i, v, label, *_ in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: B905, E731  a shorter vector counts as filled with zeros
    out = Counter()
    for i, v, label in usable:
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, other) for j, w, other in usable if j != i))
        for s, positive, _ in [r for r in scored if r[2] == label][:5]:
            fits = [(t, j) for t, j, other in scored if other != label and window[0] * -s <= 100 * -t <= window[1] * -s]
            for rank, (t, j) in enumerate(fits[:10], 1):
                out[(i, positive, rank, j, -s, -t)] += 1
    return out


def awkward_vectors(n: int, copies: int) -> list[tuple]:
    source = np.random.default_rng(12)
    middles = source.normal(0, 0.2, (6, 9))
    rows = []
    for i in range(n):
        v = (middles[i % 6] + source.normal(0, 0.15, 9)).tolist()
        rows.append((i, v, int(source.integers(0, 4)), 1, "a", 2))
    # A third of all rows have one vector; some have none that can be used.
    rows += [(n + i, middles[0].tolist(), i % 3, 1, "a", 2) for i in range(copies)]
    rows += [(5000, None, 1, 0, "", 0), (5001, [0.1, None, 0.2], 1, 0, "", 0), (5002, [0.1, float("nan")], 1, 0, "", 0)]
    rows += [(5010, [float("inf")] * 9, 1, 0, "", 0), (5020, [0.5] * 9, None, 0, "", 0), (None, [0.5] * 9, 1, 0, "", 0)]
    rows += [(5030, [], 1, 0, "", 0), (5040, [0.3, 0.2], 2, 0, "", 0), (5050, [0.0] * 9, 2, 0, "", 0)]
    return rows + [rows[10], rows[10], (rows[20][0], rows[21][1], rows[20][2], 0, "", 0)]


@pytest.mark.parametrize(("n", "copies"), [(1500, 700), (30, 4)])
def test_hard_negatives(spark, monkeypatch, n, copies):
    rows = awkward_vectors(n, copies)
    df = spark.createDataFrame(rows, EMBEDDING_SCHEMA).repartition(3)
    monkeypatch.setattr(hard_negatives, "GROUP_ASKS", 8)
    monkeypatch.setattr(hard_negatives, "CHUNK_BLOCKS", 1)
    got = hard_negatives.mine(df, F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows, 20, 256, (30, 90))


def test_hard_negatives_with_large_values(spark):
    """Products beyond 2**53 are exact too."""
    source = random.Random(7)
    rows = [(i, [float(source.randint(-9, 9) * 65536 + source.randint(0, 9)) for _ in range(4)], i % 3, 0, "", 0) for i in range(60)]
    got = hard_negatives.mine(spark.createDataFrame(rows, EMBEDDING_SCHEMA), F.col("vec_id") % 7 == 0, scale=128)
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows, 7, 128, (30, 90))


def test_hard_negatives_without_rows(spark):
    nothing = spark.createDataFrame([], EMBEDDING_SCHEMA)
    assert hard_negatives.mine(nothing, F.lit(True)).collect() == []
    few = spark.createDataFrame(awkward_vectors(30, 0)[:4], EMBEDDING_SCHEMA)
    assert hard_negatives.mine(few, F.lit(None).cast("boolean")).collect() == []


# Prefix trie -------------------------------------------------------------------------------------


def test_perfect_hash():
    source = np.random.default_rng(5)
    keys = source.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    table = prefix_trie.PerfectHash(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(5000))
    assert (table.digests[table.slots(keys)] == keys).all()
    others = source.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    assert (table.slots(others) == -1).all()
    assert len(prefix_trie.PerfectHash(keys[:0]).slots(keys)) == 5000


def brute_trie(rows: list[tuple]) -> Counter:
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    plain = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in plain.items():
        start, h = c - int(math.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(plain.get(start, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = Counter()
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        joined = ",".join(map(str, sorted(ends[p])))
        parent = min(members[p[:-1]]) if p else None
        leaves = sum(not children[q] for q in below)
        out[(min(own), len(p), parent, len(own), children[p], leaves, saved, hashlib.sha256(joined.encode()).hexdigest())] += 1
    return out


TURN_SCHEMA = "conv_id long, turn long, role string, text string, digest int, depth int, parent string"


def awkward_turns() -> list[tuple]:
    source = random.Random(13)
    say = ["yes", "no", "", "a b", "日本", None]
    rows = []
    for conv in range(60):
        # A third of the conversations are one conversation; some have gaps and numbers twice.
        count = 4 if conv % 3 == 0 else source.randint(1, 12)
        for turn in range(count):
            text = "same" if conv % 3 == 0 else source.choice(say)
            rows.append((conv, turn * 2, ["user", "bot", None][turn % 3], text, 1, 2, "p"))
    rows += [(61, None, "user", "null turn", 1, 1, ""), (61, None, "bot", "another", 1, 1, ""), (61, 0, None, None, 1, 1, "")]
    rows += [(62, 1, "a", "b:c", 1, 1, ""), (63, 1, "ab", ":c", 1, 1, ""), (-3, 0, "u", "below", 1, 1, ""), (-3, 1, "u", "zero", 1, 1, "")]
    rows += [(None, 0, "user", "no conversation", 1, 1, ""), (4, 100, "user", "x" * 100_000, 1, 1, "")]
    rows += [(70, t, "user", f"turn {t % 5}", 1, 1, "") for t in range(90)]
    rows += [(71, t, "user", f"turn {t % 5}" if t < 70 else "else", 1, 1, "") for t in range(90)]
    return rows + rows[5:9]


@pytest.mark.parametrize("stretch", [prefix_trie.STRETCH, 4])
def test_prefix_trie(spark, stretch):
    rows = awkward_turns()
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURN_SCHEMA).repartition(4), stretch=stretch)
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_prefix_trie_without_rows(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURN_SCHEMA)).collect() == []
    only_null = spark.createDataFrame([(None, 1, "a", "b", 0, 0, "")], TURN_SCHEMA)
    assert prefix_trie.prefix_trie(only_null).collect() == []
