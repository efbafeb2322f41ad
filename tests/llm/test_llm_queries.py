"""Registered text queries against SQL or brute force, and the pipeline's stages."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from conftest import SF_DIR
from oracle import duck, spark_rows, sql_rows
from test_llm_operators import brute_components, brute_repeats

import __spark_entry__ as registry
import corpus_pipeline
from onsetlab.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(name, spark):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(duck(SF_DIR), queries.ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_all_queries_are_registered():
    registered = registry.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered)


def test_token_counts(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row in queries.op1_token_counts(spark, SF_DIR).collect():
        n = len(model.encode(texts[row["doc_id"]]))
        assert (row["n_tokens"], row["over_limit"]) == (n, n > 4096)


def test_byte_bpe(spark, texts):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for row in queries.op2_byte_bpe(spark, SF_DIR).collect():
        text = texts[row["doc_id"]]
        ids = own.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(",".join(map(str, ids)).encode())
        assert row["decoded_sha256"] == sha(text.encode())


def test_linked_documents(spark, texts):
    sets, find = brute_components(texts.items())
    for row in queries.op8_jaccard_join(spark, SF_DIR).collect():
        assert row["n_shingles"] == len(sets[row["doc_id"]][0])
        assert row["component_id"] == find(row["doc_id"])


def test_repeats(spark, texts):
    expected = {k[:4] + (hashlib.sha256(k[4]).hexdigest(),) for k in brute_repeats(list(texts.items()), 50)}
    assert set(map(tuple, queries.op9_repeats(spark, SF_DIR).collect())) == expected


def test_held_out_quality_and_scores(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in queries.op3_quality(spark, SF_DIR).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) >= 0.9 * len(rows)


def test_held_out_toxicity(spark):
    # The smallest tables have too few toxic documents to learn from (the README has the figure).
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    scored = queries.op6_toxicity(spark, folder).collect()
    assert {r["doc_id"]: r["held_out"] for r in scored} == {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in scored}
    rows = [r for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) >= 0.9 * len(rows)


def test_base_scores(spark, texts):
    """Counts and base scores of every text by plain counting; the model's own score is a log probability."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + [None] for i, t in texts.items()}
    taught = Counter(w for i, own in words.items() if zlib.crc32(str(i).encode()) % 10 for w in own)
    total, kinds = sum(taught.values()), len(taught)
    for r in queries.op4_lm_scores(spark, SF_DIR).collect():
        own = words[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in taught for w in own), total)
        base = sum(math.log10((taught[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


AWKWARD = "doc_id long, text string, n_chars long, n_bytes int, removed string, kept string, found int, score double, row int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Good, repeated, near, empty and null texts in a table whose columns have the names of new ones."""
    good = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect() if r["text"] and 300 < len(r["text"]) < 3000][:30]
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    rows = [(i, t) for i, t in enumerate(good)] + [(100, good[0]), (101, good[1] + " and more"), (101, good[1] + " and more")]
    rows += [(102, ""), (103, None), (104, f"{item} {good[2]}"), (105, "x" * 200_000), (None, good[3]), (None, None)]
    return spark.createDataFrame([(i, t, len(t or ""), 1, "a", "b", 2, 0.5, 7) for i, t in rows], AWKWARD).repartition(3).cache()


def plain_rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, awkward, stage):
    kept = stage(spark, awkward, SF_DIR)
    assert kept.schema == awkward.schema or [f.dataType for f in kept.schema] == [f.dataType for f in awkward.schema]
    assert kept.columns == awkward.columns
    others = [c for c in awkward.columns if c not in ("text", "n_chars")]
    assert plain_rows(kept.select(others)) <= plain_rows(awkward.select(others))
    empty = stage(spark, awkward.where("false"), SF_DIR)
    assert empty.columns == awkward.columns and empty.count() == 0


def test_near_copies_go_but_one(spark, awkward):
    rows = [(r["doc_id"], r["text"] or "") for r in awkward.collect() if r["doc_id"] is not None]
    _, find = brute_components(rows)
    kept = corpus_pipeline.one_of_each(spark, awkward, SF_DIR)
    assert plain_rows(kept) == Counter({r: n for r, n in plain_rows(awkward).items() if r[0] is None or find(r[0]) == r[0]})


def test_repeats_go_and_all_else_stays(spark, awkward):
    # One row an id: the brute-force version knows no rows of one id.
    docs = awkward.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    known = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"]: r for r in corpus_pipeline.without_repeats(spark, docs, SF_DIR).collect()}
    assert set(kept) == set(known)
    removed = {k[0]: k for k in brute_repeats([(i, r["text"] or "") for i, r in known.items()], 50)}
    for i, r in known.items():
        if removed[i][2] == 0:
            assert kept[i] == r
        elif (r["text"] or "").isascii():
            assert kept[i]["text"].encode() == removed[i][4] and kept[i]["n_chars"] == len(removed[i][4])
    assert (kept[102]["text"], kept[103]["text"]) == ("", None)


def test_benchmark_passages_go(spark, awkward):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda t: re.findall(word, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        own = words(r["text"])
        size = min(10, len(own))
        windows |= {tuple(own[i : i + size]) for i in range(len(own) - size + 1) if size}
    sizes = {len(w) for w in windows}

    def clean(text):
        own = words(text)
        return not any(tuple(own[i : i + n]) in windows for n in sizes for i in range(len(own) - n + 1))

    kept = corpus_pipeline.without_benchmark(spark, awkward, SF_DIR)
    expected = Counter({r: n for r, n in plain_rows(awkward).items() if clean(r[1])})
    assert plain_rows(kept) == expected and 104 not in {r[0] for r in expected}


def test_pipeline_stages(spark, texts):
    folder, docs = SF_DIR, spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        docs = kept.cache()
        left.append(docs.count())
    assert sorted(left, reverse=True) == left and left[-1] > left[0] / 2
    rows = docs.select("doc_id").collect()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in final} == {r["doc_id"] for r in rows}
    assert all(r["round_trip"] for r in final)


def test_pipeline_runs_as_a_whole(spark):
    assert corpus_pipeline.run(spark, SF_DIR).where("round_trip").count() > 100
