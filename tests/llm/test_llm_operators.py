"""The text operators against brute force, on awkward rows."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken

from onsetlab.llm import (
    attention,
    byte_bpe,
    decontaminate,
    impact_search,
    jaccard_join,
    lm,
    quality,
    repeats,
    token_counts,
    toxicity,
    url_filter,
)
from onsetlab.llm.buffers import utf8
from onsetlab.llm.components import components

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, id int, block int, score string"


def awkward_texts() -> list[str | None]:
    source = random.Random(4)
    words = ["the", "thing", "Über", "naïve", "日本", "😀", "a", "x1", "and,", "\u00a0", "don't"]
    texts = [" ".join(source.choices(words, k=source.randint(0, 40))) for _ in range(60)]
    long = " ".join(source.choices(words, k=4000))
    return [*texts, None, "", "   \n\t ", long, long + " the", "a" * 3000, "日本語" * 500, texts[0], texts[0]]


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with repeated rows, a null id, and columns whose names operators use themselves."""
    rows = [(i, t, "en", 1, 2, "s") for i, t in enumerate(awkward_texts())]
    rows += [(3, rows[3][1], None, None, None, None), (None, "no id here", None, 1, 1, "z"), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def text_rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


# Token counts


def test_token_counts(docs, nothing):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counted = token_counts.count_tokens(docs, PIECES, chunk=500, overlap=16)
    expected = Counter((i, len(t.encode()), len(model.encode(t))) for i, t in text_rows(docs))
    assert Counter(map(tuple, counted.collect())) == expected
    assert token_counts.count_tokens(nothing, PIECES).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(64, 1), (100, 8), (301, 33)])
def test_spliced_chunks_are_the_whole_encoding(chunk, overlap):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    source = random.Random(chunk)
    texts = ["a" * 999, "ab" * 400, " " * 700, "".join(source.choices("ab cé日😀\n", k=2000)), "".join(source.choices("thering", k=2000))]
    for text in texts:
        assert [t[2] for t in token_counts.encode_long(model, text, chunk, overlap)] == model.encode(text)
        for reach in (None, overlap, 3 * chunk):
            assert token_counts.count_long(model, text, chunk, overlap, reach) == len(model.encode(text))


def test_few_tokens_of_a_huge_text_are_held():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = " ".join(random.Random(3).choices(["river", "stone", "walks", "unhappily", "42"], k=60_000))
    gone, last = token_counts.splice(model, text, 4096, 256, 4096)
    assert gone + len(last) == len(model.encode(text)) and len(last) <= 4096


# Byte-level BPE


@pytest.mark.parametrize("native", [False, True])
def test_encoding_and_decoding(docs, nothing, native):
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
    encoded = byte_bpe.encode(docs, RANKS, PATTERN, native=native, known_words=20)
    assert encoded.columns == [*docs.columns, "ids"]
    rows = byte_bpe.decode(encoded, RANKS).collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = row["text"] or ""
        assert row["ids"] == own.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    assert byte_bpe.encode(nothing, RANKS, PATTERN, native=native).count() == 0


def test_merges_of_odd_words():
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
    source = random.Random(2)
    words = ["".join(source.choices("aabé 日😀thing", k=source.randint(1, 300))).encode() for _ in range(200)]
    merged = byte_bpe.merge_words(words, RANKS, byte_bpe.PairTable(RANKS))
    assert [m.tolist() for m in merged] == [own._encode_single_piece(w) for w in words]


def test_ranks_must_hold_all_bytes(docs):
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.encode(docs, {b"a": 0}, PATTERN)


# Quality and toxicity


def labelled(spark, n=400):
    source = random.Random(9)
    words = ["stone", "river", "cloud", "green", "walks", "under", "light", "paper", "seven", "north"]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(source.choices(words, k=30)).capitalize() + "."
        bad, toxic = i % 4 == 0, i % 5 == 0
        if toxic:
            text = text.replace("river", "vilethug").replace("cloud", "vilethought") + " vilethud"
        if bad:
            text = "!! ".join(text.upper().split()) + "!!"
        rows.append((i, text))
        labels.append((i, 0 if bad else 1, int(toxic)))
    labels += [(None, 1, 1), (0, None, None), (n + 5, 1, 0), (7, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_of_held_out_texts(spark, docs, nothing):
    known, labels = labelled(spark)
    model = quality.fit(known, labels.where("doc_id % 3 <> 0"))
    scored = quality.with_quality(known, model).where("doc_id % 3 = 0").collect()
    right = sum((r["score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in scored)
    assert right >= 0.98 * len(scored)
    awkward = quality.with_quality(docs, model)
    assert awkward.columns.count("score") == 1 and awkward.count() == docs.count()
    assert awkward.where("score IS NULL OR score < 0 OR score > 1 OR isnan(score)").count() == 0
    assert quality.with_quality(nothing, model).count() == 0


def test_quality_without_two_labels(spark, docs, nothing):
    _, labels = labelled(spark)
    for some in (labels.where("quality = 1"), labels.limit(0)):
        scores = quality.with_quality(docs, quality.fit(docs, some)).select("score").distinct().collect()
        assert len(scores) == 1 and 0 < scores[0]["score"] < 1
    assert quality.fit(nothing, labels) is not None


def test_the_sample_is_bounded_and_the_same_every_time(spark):
    known, labels = labelled(spark, 60)
    ids = quality.one_label(labels, "doc_id", "quality")
    assert ids.where("id = 7").count() == 0  # it has both labels
    sample = [quality.bounded_sample(ids.repartition(n), 20).collect() for n in (1, 5)]
    assert len(sample[0]) == 20 and sorted(sample[0]) == sorted(sample[1])


def test_toxicity_of_held_out_texts(spark, docs, nothing):
    known, labels = labelled(spark)
    model = toxicity.fit(known, labels.where("doc_id % 3 <> 0"))
    judged = toxicity.with_toxicity(known, model).where("doc_id % 3 = 0").collect()
    right = sum((r["toxicity"]["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in judged)
    assert right >= 0.98 * len(judged)
    for row in judged:
        spans = [row["text"][s["first"] : s["last"]].lower() for s in row["toxicity"]["spans"]]
        assert all("vile" in s for s in spans) and bool(spans) == (row["doc_id"] % 5 == 0)
    awkward = toxicity.with_toxicity(docs, model, name="score")
    assert awkward.columns.count("score") == 1 and awkward.count() == docs.count()
    assert awkward.where("score.score IS NULL OR isnan(score.score)").count() == 0
    assert toxicity.with_toxicity(nothing, model).count() == 0
    one_sided = toxicity.fit(known, labels.where("toxic = 0"))
    assert toxicity.with_toxicity(docs, one_sided).select("toxicity.score").distinct().count() == 1


def test_long_texts_teach_toxicity(spark):
    known, labels = labelled(spark)
    # All texts are longer, and the last word of a toxic one is not its only toxic word.
    model = toxicity.fit(known, labels.where("doc_id % 3 <> 0"))
    judged = toxicity.with_toxicity(known, model).where("doc_id % 3 = 0").collect()
    right = sum((r["toxicity"]["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in judged)
    assert right >= 0.95 * len(judged)
    assert toxicity.FIT_ROWS == 8192


def test_training_in_groups_is_training_at_once(monkeypatch):
    source = random.Random(2)
    vocabulary = toxicity.Vocabulary()
    texts = [vocabulary.read(" ".join(source.choices(["vile", "nice", "day", "word", "x1"], k=source.randint(0, 600)))) for _ in range(30)]
    vocabulary.close()
    labels = [(t == 0).astype(np.uint8) for t in texts]
    whole = toxicity.train_chain(vocabulary, texts, labels, rounds=8)
    monkeypatch.setattr(toxicity, "TOKENS_AT_ONCE", 700)
    parts = toxicity.train_chain(vocabulary, texts, labels, rounds=8)
    assert np.allclose(whole.weight, parts.weight, atol=1e-9) and np.allclose(whole.moves, parts.moves, atol=1e-9)


def test_marginals_equal_sums_over_all_taggings():
    source = np.random.default_rng(3)
    lengths = np.array([4, 0, 1, 6], np.int64)
    model = toxicity.ToxicityModel(np.zeros(1), 0.3, np.array([[0.0, -1.2], [-0.4, 0.9]]), np.zeros(4))
    emissions = source.normal(size=lengths.sum())
    found, clean = model.marginals(emissions, lengths)
    at = 0
    for n, p, c in zip(lengths, found, clean, strict=True):
        own, at = emissions[at : at + n], at + n
        weights = {}
        for tags in range(1 << n):
            y = [(tags >> i) & 1 for i in range(n)]
            total = sum(own[i] * y[i] for i in range(n)) + (0.3 * y[0] if n else 0)
            total += sum(model.moves[y[i], y[i + 1]] for i in range(n - 1))
            weights[tuple(y)] = math.exp(total)
        z = sum(weights.values())
        assert p == pytest.approx([sum(w for y, w in weights.items() if y[i]) / z for i in range(n)])
        assert c == pytest.approx(math.log(weights[(0,) * n] / z))


# Language model


def test_language_model_counts_and_scores(docs, nothing):
    from pyspark.sql import functions as F

    taught = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(10)) != 0
    model = lm.fit(docs.where(taught), RANKS, PATTERN, steps=30)
    scored = lm.score_texts(docs, taught, model, RANKS, PATTERN, block_bytes=20_000).collect()
    rows = [(i, t.encode().lower().split() + [None]) for i, t in text_rows(docs)]
    counts: Counter = Counter()
    for i, words in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 10:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    expected = Counter(
        (i, len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6))
        for i, w in rows
    )
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in scored) == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in scored)
    assert lm.score_texts(nothing, taught, model, RANKS, PATTERN).count() == 0
    assert lm.fit(nothing, RANKS, PATTERN) is not None


def test_words_and_spellings_equal_plain_ones():
    texts = [b"", b" Ab c\x0bd\x00 ab\t", "caf\u00e9 \u00a0 x\u2003y Z\u00c4".encode(), b"it's 42% ...", b"\n \r", b"ab" * 300]
    data, offsets = utf8(pa.array([t.decode() for t in texts]))
    known, numbers, lengths = lm.words_in(data, offsets)
    plain = [t.lower().split() for t in texts]
    assert [known[i] for i in numbers] == [w for own in plain for w in own]
    assert lengths.tolist() == [len(own) for own in plain] and len(set(known)) == len(known)
    subwords = lm.Subwords(RANKS, PATTERN)
    for words in (known, [w for w in known if w.isascii()], []):
        ids, sizes = lm.spelled(words, subwords)
        expected = [*map(subwords.ids, words), [subwords.end]]
        assert ids.tolist() == [i for own in expected for i in own] and sizes.tolist() == [len(own) for own in expected]
    x, y, start = lm.stream(numbers, lengths, len(known))
    end = len(known)
    assert y.tolist() == [n for own in plain for n in [*(known.index(w) for w in own), end]]
    assert x.tolist() == [n for own in plain for n in [end, *(known.index(w) for w in own)]]
    assert len(start) == len(x) and all(x[s] == end for s in start.tolist())
    for values in ([], [0], [255, 256], [1 << 40, 3]):
        assert lm._unpacked(lm._packed(np.array(values, np.int64))).tolist() == values


def test_language_model_gathers_from_all_documents(spark):
    from pyspark.sql import functions as F

    source = random.Random(13)
    words = [w for w in ("unhappily", "rewriting", "zymurgical", "quixotically", "the", "of", "xylophonist")]
    rows = [(i, " ".join(source.choices(words[:6], k=12))) for i in range(2300)]
    rows += [(9000, " ".join(source.choices(words, k=4000)))]  # over 20,000 characters, and one word only here
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = lm.fit(df, RANKS, PATTERN, steps=4)
    subwords = lm.Subwords(RANKS, PATTERN)
    pairs, ids = Counter(), Counter()
    for _, text in rows:
        for word in text.encode().split():
            own = subwords.ids(word)
            ids.update(own)
            pairs.update(zip(own, own[1:]))
    space = len(model.number)
    assert {(p // space, p % space): n for p, n in zip(model.pairs.tolist(), model.pair_counts.tolist())} == pairs
    gathered = lm.gather(lm.pack(df, F.lit(True), RANKS, PATTERN))
    assert {i: n for i, n in enumerate(gathered.by_id[:, -3].tolist()) if n and i != subwords.end} == ids
    assert gathered.by_id[subwords.end, -3] == len(rows)
    first = attention.untrained(gathered)
    moved = np.abs(model.embedding - first.embedding).max(1) > 0
    assert all(moved[model.number[i]] for i in subwords.ids(b"xylophonist"))


def test_steps_of_tasks_teach(spark):
    # Each word has one follower, so the class of the next word can be learned.
    ring = ["stone", "river", "cloud", "green", "walks", "under", "light", "paper"]
    rows = [(i, " ".join(ring[(i + k) % 8] for k in range(40))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    scores = []
    for steps in (1, 400):
        model = lm.fit(df, RANKS, PATTERN, steps=steps)
        scored = lm.score_texts(df, df.doc_id >= 0, model, RANKS, PATTERN).agg({"score": "avg"})
        scores.append(scored.first()[0])
    assert scores[1] > 0.5 * scores[0]


def test_class_probabilities_are_causal_and_sum_to_one():
    source = np.random.default_rng(5)
    sizes = source.integers(1, 4, 50)
    ids = source.integers(0, 300, sizes.sum())
    x = source.integers(0, 50, 400)
    start = np.where(np.arange(400) < 170, 0, 170)
    model = attention.train(x, np.roll(x, -1), start, ids, sizes, 301, steps=20, classes=8)
    vectors = model.vectors(ids, sizes)
    total = sum(np.exp(model.log_classes(x, np.full(400, k), start, vectors)) for k in range(8))
    assert total == pytest.approx(np.ones(400), abs=1e-4)
    before = model.log_classes(x, np.zeros(400, np.int64), start, vectors)
    changed = x.copy()
    changed[300:] = (changed[300:] + 1) % 50
    after = model.log_classes(changed, np.zeros(400, np.int64), start, vectors)
    assert after[:300] == pytest.approx(before[:300], abs=1e-5)
    alone = model.log_classes(x[170:], np.zeros(230, np.int64), start[170:] - 170, vectors)
    # Windows fall elsewhere, so only the first ones of the text see all of it.
    assert alone[:20] == pytest.approx(before[170:190], abs=1e-4)


# Search


def test_search_equals_brute_force(spark):
    source = random.Random(8)
    rows = [(i, [source.gauss(0, 0.3) for _ in range(12)]) for i in range(300)]
    rows += [(301, None), (302, [None] * 12), (303, [float("nan")] * 12), (304, [float("inf")] * 12), (305, rows[5][1]), (306, rows[5][1])]
    rows += [(307, [0.0] * 12), (308, []), (None, [0.1] * 12), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and i not in (301, 302, 303, 304)]
    expected = Counter()
    queries = {i: v for i, v in vectors if i % 20 == 0}
    for q, a in queries.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)
        repeats_of_q = sum(i == q for i, _ in vectors)
        best = sorted(scores * 1)[:7]
        for rank, (score, i) in enumerate(best, 1):
            expected[q, rank, i, -score] += 1
        assert repeats_of_q in (1, 2)
    found = impact_search.top_k(df, df.where("vec_id % 20 = 0").dropDuplicates(["vec_id"]), 7, levels=4, rows_in_block=64)
    assert Counter(map(tuple, found.collect())) == expected
    assert impact_search.top_k(df.limit(0), df.limit(0), 7).count() == 0


# URLs


def test_url_verdicts(spark):
    rules = [
        url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
        url_filter.Rule("allow", "www.example.com", "/en/"),
    ]
    cases = [
        (1, "http://a.EXAMPLE.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        (2, "http://www.example.com/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (3, "http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        (4, "http://b.net/casino/x", "b.net", "/casino/x", None, "block"),
        (5, "http://b.net/casinos?free", "b.net", "/casinos", None, "allow"),
        (6, "http://free-x.net?bonus#a", "free-x.net", "", None, "block"),
        (7, "nothing free", "", "", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "", "", "", None, "allow"),
        (10, "x://h\n/é?", "h\n", "/é", None, "allow"),
    ]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u, *_ in cases], "page_id int, url string, host string, rule string")
    judged = url_filter.judge_urls(df, rules).drop("strict_terms", "soft_terms")
    assert sorted(map(tuple, judged.collect())) == sorted((i, *rest) for i, _, *rest in cases)
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    twice = url_filter.judge_urls(df.union(df), rules).drop("strict_terms", "soft_terms")
    assert Counter(map(tuple, twice.collect())) == Counter((i, *rest) for i, _, *rest in cases for _ in range(2))


def test_url_verdicts_of_very_long_urls(spark):
    clean = "http://x.net/" + "a/freedom/" * 100_000
    df = spark.createDataFrame([(1, clean), (2, clean + "poker"), (3, clean + "free?a=win"), (4, clean + "free?free")], "page_id int, url string")
    judged = {r["page_id"]: r for r in url_filter.judge_urls(df, []).collect()}
    assert [judged[i]["verdict"] for i in (1, 2, 3, 4)] == ["allow", "block", "block", "allow"]
    assert judged[3]["soft_terms"] == ["free", "win"] and judged[2]["path"] == clean[len("http://x.net") :] + "poker"


def test_url_vocabulary_from_a_weighted_table(spark):
    rows = [("Poker", 3.0), ("poker", 0.5), ("win", 1.0), ("free", 2.9), ("none", 0.0), ("odd", None), ("", 5.0), (None, 5.0), ("nan", float("nan"))]
    table = spark.createDataFrame([(t, w, "x") for t, w in rows], "term string, weight double, other string")
    strict, soft = url_filter.weighted_terms(table, 3.0)
    assert (strict, soft) == (("poker",), ("free", "win"))
    df = spark.createDataFrame([(1, "h://a/POKER"), (2, "h://a/win-win"), (3, "h://win.a/free"), (4, "h://none/odd")], "page_id int, url string")
    judged = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df, [], strict=strict, soft=soft).collect()}
    assert judged == {1: "block", 2: "allow", 3: "block", 4: "allow"}
    assert url_filter.weighted_terms(table.limit(0), 3.0) == ((), ())
    assert {r["verdict"] for r in url_filter.judge_urls(df, [], strict=(), soft=()).collect()} == {"allow"}
    with pytest.raises(ValueError, match="bytes of terms"):
        url_filter.weighted_terms(table, 3.0, max_bytes=10)


def test_checkpoints_are_noted_for_removal(spark):
    from onsetlab.llm.scratch import cut, written_to
    from onsetlab.sources.staging import session_stages

    done = cut(spark.range(5).selectExpr("id * 2 AS a"))
    assert sorted(r["a"] for r in done.collect()) == [0, 2, 4, 6, 8]
    assert written_to(done) in session_stages(spark).others


# Similar documents


def brute_components(rows, size=5):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        shingles = frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()
        sets.setdefault(i, []).append(shingles)
    parent = {i: i for i in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, many in sets.items() if i is not None for s in many if s]
    for a, (i, x) in enumerate(flat):
        for j, y in flat[:a]:
            if 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sets, find


def near_copies():
    source = random.Random(12)
    base = [f"w{source.randint(0, 400)}" for _ in range(60)]
    rows = []
    for i in range(150):
        words = list(base) if i % 3 else [f"w{source.randint(0, 400)}" for _ in range(source.randint(1, 60))]
        for _ in range(source.randint(0, 3)):
            words[source.randrange(len(words))] = f"v{source.randint(0, 90)}"
        rows.append((1000 - i, " ".join(words)))
    return rows


@pytest.mark.parametrize("cell_rows", [1024, 7])
def test_linked_documents(spark, docs, cell_rows):
    rows = [*text_rows(docs), *near_copies()]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
    sets, find = brute_components(rows)
    found = jaccard_join.link_documents(df, cell_rows=cell_rows).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["n_shingles"] in {len(s) for s in sets[row["doc_id"]]}
        assert row["component_id"] == (None if row["doc_id"] is None else find(row["doc_id"]))


def two_texts_of_an_id():
    """Id 7 has a copy of the text of id 3 and a text of its own, which 9 nearly has."""
    source = random.Random(21)
    a, b = (" ".join(f"w{source.randint(0, 9000)}" for _ in range(60)) for _ in range(2))
    return [(3, a), (7, a), (7, b), (9, b + " more"), (11, "something else")]


def test_linked_documents_of_an_id_with_two_texts(spark):
    rows = two_texts_of_an_id()
    _, find = brute_components(rows)
    found = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found if r["doc_id"] == 7} == {3}
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == sorted((i, 3 if i < 11 else 11) for i, _ in rows)
    assert all(find(r["doc_id"]) == r["component_id"] for r in found)


def test_a_block_of_copies_unpacks_no_copy():
    packed = jaccard_join.pack(np.arange(1 << 17, dtype=np.uint64))
    rows, keys = range(32), [bytes([i]) * 16 for i in range(32)]
    docs = pa.table({"id": [*rows], "n": [1 << 17] * 32, "key": keys, "tokens": [packed] * 32})
    copies = [(0, "copies", np.arange(1, 32).tobytes(), b"".join(keys[1:]), b"")]
    table = pa.table(dict(zip(["block", "kind", "first", "second", "third"], map(list, zip(*copies)))))
    tracemalloc.start()
    try:
        ids, sizes, sets = jaccard_join._without_copies(docs, table)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (ids.tolist(), sizes.tolist(), len(sets[0])) == ([0], [1 << 17], 1 << 17)
    assert most < 16 * len(packed)


def test_linking_nothing(nothing):
    assert jaccard_join.link_documents(nothing).count() == 0


def test_components_of_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    expected = {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (200, 200)}
    assert set(map(tuple, found.collect())) == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Repeats


def brute_repeats(rows, length):
    first: dict[bytes, int] = {}
    ordered = sorted((i, t.encode()) for i, t in rows if i is not None)
    for i, data in ordered:
        for p in range(len(data) - length + 1):
            first.setdefault(data[p : p + length], i)
    out = Counter()
    for i, t in rows:
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if i is not None and first[data[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        out[i, len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), bytes(c for c, g in zip(data, gone) if not g)] += 1
    return out


@pytest.mark.parametrize("length,gram,block_bytes", [(50, 24, 8 << 20), (50, 24, 3000), (6, 3, 500), (6, 6, 500)])
def test_removed_repeats(spark, docs, length, gram, block_bytes):
    source = random.Random(length)
    passage = "".join(source.choices("abc déf", k=90))
    rows = text_rows(docs)
    for i in range(40):
        text = "".join(source.choices("abc d", k=source.randint(0, 120)))
        rows.append((2000 - i, text[:30] + passage[source.randint(0, 40) :] + text[30:] if i % 2 else text))
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, kept string")
    cut = repeats.remove_repeats(df, length=length, gram=gram, block_bytes=block_bytes).collect()
    found = Counter()
    for r in cut:
        found[r["doc_id"], r["n_bytes"], sum(s["last"] - s["first"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])] += 1
    assert found == brute_repeats(rows, length)
    whole = repeats.remove_repeats(df, length=length, gram=gram, block_bytes=block_bytes, characters=True)
    assert all(bytes(r["kept"]).decode("utf-8") is not None for r in whole.collect())


def common_line(n=300):
    """A line of 40 bytes that all texts hold, between others of their own."""
    source = random.Random(31)
    line = "the one line that all of the pages hold "
    own = lambda: "".join(source.choices("abcdefgh ", k=90))
    return [(i, own() + line + own() + (own() + line) * (i % 3)) for i in range(n)]


@pytest.mark.parametrize("anchor_windows", [1, 500])
def test_a_line_between_different_texts_is_divided(spark, anchor_windows):
    rows = [*common_line(60), *((900 + i, t[20:200] + "x" + t[30:]) for i, t in common_line(20))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter()
    for r in repeats.remove_repeats(df, block_bytes=4000, anchor_windows=anchor_windows).collect():
        found[r["doc_id"], r["n_bytes"], sum(s["last"] - s["first"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])] += 1
    assert found == brute_repeats(rows, 50)


def test_no_shard_key_holds_all_surroundings_of_a_line():
    texts = [t.encode() for _, t in common_line()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    anchors = repeats.window_anchors(data, offsets, 50, 24)
    hits, counts = np.unique(anchors[anchors != repeats._NONE], return_counts=True)
    assert counts.max() > 3000
    divided = repeats.Stretches.of(data, offsets, hits, 50, 24, counts > 60)
    whole = repeats.Stretches.of(data, offsets, hits, 50, 24)
    # Each different stretch is sent once, by its key.
    most = lambda s: np.unique(s.anchors[s.first], return_counts=True)[1].max()
    assert most(whole) > 200 and most(divided) <= 60
    windows = lambda s: sorted(p for a, b in zip(s.starts, s.ends) for p in range(a, b - 49))
    assert windows(divided) == windows(whole)


def test_heavy_numbers_are_told_to_all_their_blocks():
    import pyarrow as pa

    from onsetlab.llm import blocks

    values = np.array([5, 5, 9, 11], np.uint64)
    sent = [blocks.shard_notes(values, np.array([b, b + 9, b, b], np.int64), b, 1, np.array([90, 90, 3, 70])) for b in range(3)]
    told = blocks.repeated_notes(pa.concat_tables(sent), 600)
    for block in range(3):
        known, levels = blocks.hits_in(told.filter(pa.array([v == block for v in told.column("block").to_pylist()])))
        assert known.tolist() == [5, 9, 11] and (levels >= blocks.HEAVY).tolist() == [True, False, False]


def test_removed_repeats_of_an_id_with_two_texts(spark):
    rows = two_texts_of_an_id()
    cut = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter()
    for r in cut:
        found[r["doc_id"], r["n_bytes"], sum(s["last"] - s["first"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])] += 1
    assert found == brute_repeats(rows, 50)
    assert (7, len(rows[2][1]), 0, 0, rows[2][1].encode()) in found


def test_removing_from_nothing(nothing):
    cut = repeats.remove_repeats(nothing)
    assert cut.columns == ["doc_id", "lang", "id", "block", "score", "n_bytes", "removed", "kept"] and cut.count() == 0


def test_maximal_repeats_equal_brute_force():
    source = random.Random(6)
    for _ in range(40):
        strings = ["".join(source.choices("ab", k=source.randint(4, 14))).encode() for _ in range(5)]
        least = 3
        suffixes = [(n, s, p) for n, s in enumerate(strings) for p in range(len(s) - least + 1)]
        begins = np.cumsum([0, *map(len, strings)])
        starts = np.array([begins[n] + p for n, _, p in suffixes])
        ends = np.repeat(begins[1:], [len(s) for s in strings])
        lengths = np.array([len(s) - p for _, s, p in suffixes])
        left = np.array([s[p - 1] if p else -1 for _, s, p in suffixes], np.int16)
        owner = np.array([n for n, _, _ in suffixes])
        order, shared = repeats.sorted_suffixes(np.frombuffer(b"".join(strings), np.uint8), starts, lengths, ends)
        found = repeats.maximal_repeats(order, shared, left, owner, least)
        got = {
            (suffixes[order[a]][1][suffixes[order[a]][2] :][:size], frozenset((suffixes[k][0], suffixes[k][2]) for k in order[a : b + 1]), low)
            for a, b, size, low in found
        }
        expected = set()
        for text in {s[p : p + n] for _, s, p in suffixes for n in range(least, len(s) - p + 1)}:
            at = [(n, p) for n, s, p in suffixes if s[p : p + len(text)] == text]
            after = {strings[n][p + len(text) : p + len(text) + 1] or (n, p) for n, p in at}
            before = {strings[n][p - 1] if p else (n, p) for n, p in at}
            if len(at) > 1 and len(after) > 1 and len(before) > 1:
                expected.add((text, frozenset(at), min(n for n, _ in at)))
        assert got == expected


def test_only_windows_that_another_owner_may_hold_are_sorted(monkeypatch):
    source = random.Random(12)
    sorted_ones, plainly = [], repeats.sorted_suffixes
    monkeypatch.setattr(repeats, "sorted_suffixes", lambda data, starts, *more: sorted_ones.append(len(starts)) or plainly(data, starts, *more))
    least, skipped = 6, 0
    for letters in ("ab", "abcdefgh"):
        for _ in range(30):
            strings = ["".join(source.choices(letters, k=source.randint(least, 30))).encode() for _ in range(12)]
            strings += [strings[0], strings[1][2:] + b"zz" * least, b"z" * 40]
            owner = np.array([source.randint(0, 4) for _ in strings])
            sizes = np.array([len(t) for t in strings])
            number, offset, size = repeats.marks_in_shard(b"".join(strings), sizes, owner, least)
            lowest = {}
            windows = [(n, p, t[p : p + least]) for n, t in enumerate(strings) for p in range(len(t) - least + 1)]
            for n, _, w in windows:
                lowest.setdefault(w, []).append(owner[n])
            marked = [bytearray(len(t)) for t in strings]
            for n, p, k in zip(number, offset, size, strict=True):
                marked[n][p : p + k] = b"\1" * k
            expected = [bytearray(len(t)) for t in strings]
            for n, p, w in windows:
                if min(lowest[w]) < owner[n]:
                    expected[n][p : p + least] = b"\1" * least
            assert marked == expected
            several = sum(min(lowest[w]) < max(lowest[w]) for _, _, w in windows)
            assert (sorted_ones.pop() if several else 0) == several
            skipped += len(windows) - several
    assert skipped > 1000
    # Nothing to share: nothing to sort.
    assert not repeats.marks_in_shard(b"abcdefghij", np.array([10]), np.array([1]), least)[0].size and not sorted_ones


def test_sorted_suffixes_equal_plain_sorting():
    source = np.random.default_rng(8)
    for letters, longest in ((2, 113), (1, 113), (255, 40), (2, 5), (3, 200)):
        sizes = source.integers(1, longest + 1, 12)
        strings = [source.integers(1, letters + 1, n).astype(np.uint8).tobytes() for n in sizes]
        strings += [strings[0], strings[1][: len(strings[1]) // 2 + 1]]
        begins = np.cumsum([0, *map(len, strings)])
        places = [(n, p) for n, s in enumerate(strings) for p in range(len(s))]
        starts = np.array([begins[n] + p for n, p in places])
        lengths = np.array([len(strings[n]) - p for n, p in places])
        ends = np.repeat(begins[1:], [len(s) for s in strings])
        order, shared = repeats.sorted_suffixes(np.frombuffer(b"".join(strings), np.uint8), starts, lengths, ends)
        texts = [strings[n][p:] for n, p in places]
        padded = [t.ljust(longest, b"\0") for t in texts]
        assert order.tolist() == sorted(range(len(texts)), key=lambda i: padded[i])
        for a, b, common in zip(order[:-1], order[1:], shared[1:], strict=True):
            least = min(len(texts[a]), len(texts[b]))
            assert common == next((i for i in range(least) if texts[a][i] != texts[b][i]), least)


def test_crafted_words_do_not_meet(spark):
    """Sums of powers modulo 2**64 are the same for a long word in Thue-Morse order and its mirror."""
    order = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join("ab"[x ^ flip] for x in order) for flip in (0, 1))
    rows = [(1, one), (2, other), (3, one + " x"), (4, one.upper())]
    linked = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert linked == {1: 1, 2: 2, 3: 3, 4: 1}


# Benchmark passages


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination(spark, docs, nothing, block_bytes):
    source = random.Random(3)
    words = [f"w{n}" for n in range(60)] + ["é1", "the"]
    items = [(n, " ".join(source.choices(words, k=source.choice([1, 3, 9, 10, 14, 30])))) for n in range(12)]
    items += [(50, None), (51, "--- !"), (None, "the thing"), (3, items[3][1]), (2, items[2][1])]
    rows = text_rows(docs)
    for n in range(60):
        own = source.choices(words, k=source.randint(0, 30))
        item = items[source.randrange(12)][1].split()
        at = source.randrange(len(item))
        rows.append((3000 + n, "; ".join([*own, *item[at : at + source.randint(1, 20)], *own[:3]]).upper()))
    df = spark.createDataFrame([(i, t, "f") for i, t in rows], "doc_id long, text string, found string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    expected = Counter()
    for i, text in rows:
        own, hit, met = split(text), set(), set()
        for item, passage in items:
            other = split(passage)
            n = min(len(other), 10)
            windows = {tuple(other[k : k + n]) for k in range(len(other) - n + 1)} if n and item is not None else set()
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    met.add(str(item))
        expected[i, len(own), len(hit), tuple(sorted(met))] += 1
    found = decontaminate.find_contamination(df, bench, block_bytes=block_bytes).collect()
    got = Counter(
        (r["doc_id"], r["found"]["n_words"], sum(s["last"] - s["first"] for s in r["found"]["spans"]), tuple(r["found"]["items"]))
        for r in found
    )
    assert got == expected
    assert decontaminate.find_contamination(nothing, bench).count() == 0
    assert decontaminate.find_contamination(df, bench.limit(0)).where("size(found.items) > 0").count() == 0


@pytest.mark.parametrize("block_bytes", [64 << 20, 0])
def test_contamination_of_shared_passages_and_ties(spark, block_bytes):
    source = random.Random(11)
    passage = " ".join(f"p{n}" for n in range(20))
    # One passage in many items, a common run of words, and items of few different words.
    items = [(f"i{n}", f"{passage} own{n}") for n in range(300)] + [("a,b", "x " * 25), ("xy", "x y " * 9), ('q"', "y")]
    rows = [(1, passage), (1, passage), (2, passage[:20]), (3, "x " * 9), (4, "x " * 40 + "z " + "y x " * 8), (5, None)]
    rows += [(100 + n, " ".join(source.choices("xyz", k=40))) for n in range(40)]
    rows += [(200, "z " * 3000 + passage.upper() + " z" * 3000)]
    names = "doc_id long, text string, key string, place long, row int, hits string, n_words long"
    df = spark.createDataFrame([(i, t, "k", 5, 6, "h", -1) for i, t in rows], names)
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.find_contamination(df, bench, block_bytes=block_bytes)
    assert found.columns == [*df.columns, "found"]
    got = Counter()
    for r in found.collect():
        assert (r["key"], r["place"], r["row"], r["hits"], r["n_words"]) == ("k", 5, 6, "h", -1)
        spans = [(s["first"], s["last"]) for s in r["found"]["spans"]]
        assert spans == decontaminate.merged(spans)
        got[r["doc_id"], r["found"]["n_words"], tuple(i for a, b in spans for i in range(a, b)), tuple(r["found"]["items"])] += 1
    expected = Counter()
    known = {item: text.split() for item, text in items}
    for i, text in rows:
        own, hit, met = (text or "").lower().split(), set(), set()
        for item, other in known.items():
            n = min(len(other), 10)
            windows = {tuple(other[k : k + n]) for k in range(len(other) - n + 1)}
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    met.add(item)
        expected[i, len(own), tuple(sorted(hit)), tuple(sorted(met))] += 1
    assert got == expected
    assert sum(len(items) > 290 for *_, items in got.elements()) == 3
