"""Registered queries of the subpackage: thin digests of its operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlab.llm import (
    byte_bpe,
    decontaminate,
    fingerprints,
    hard_negatives,
    impact_search,
    jaccard_join,
    lm,
    prefix_trie,
    quality,
    repeats,
    token_counts,
    toxicity,
    url_filter,
)
from onsetlab.llm.shipping import ship

#: The rules of the URL query.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    counts = token_counts.count_tokens(_table(spark, folder, "documents"), model)
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _remainder(of: str, parts: int) -> Column:
    """crc32 of a column's text, modulo ``parts``."""
    return F.pmod(F.crc32(F.coalesce(F.col(of).cast("string"), F.lit(""))), F.lit(parts))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = _remainder("doc_id", 5) == 0
    model = quality.fit(docs, _table(spark, folder, "labels").where(~held_out))
    return quality.with_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = _remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, _table(spark, folder, "labels").where(~held_out))
    judged = toxicity.with_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity.score").alias("score"), F.col("toxicity.spans").alias("spans")
    )
    return judged.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


def op4_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = _remainder("doc_id", 10) == 0
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    corpus = lm.pack(docs, ~held_out, ranks, public_tokenizers.PATTERN)
    return lm.score_corpus(corpus, lm.fit_corpus(corpus)).select(
        F.col("id").alias("doc_id"), (~F.col("taught")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    return impact_search.top_k(rows, rows.where("vec_id % 100 = 0"), 10)


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, folder, "pages"), URL_RULES)
    return judged.drop("strict_terms", "soft_terms")


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link_documents(_table(spark, folder, "documents"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    length = lambda s: s["last"] - s["first"]
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + length(s)).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, folder, "benchmark"))
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("doc_id", "found", hit.alias("n_hit")).select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        "n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_next(_table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality": op3_quality,
    "op4_lm_scores": op4_lm_scores,
    "op5_topk_search": op5_topk_search,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_repeats": op9_repeats,
    "op10_decontamination": op10_decontamination,
    "op11_fingerprints": op11_fingerprints,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op5_topk_search": """
        WITH vectors AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vectors),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM parts q JOIN parts c USING (d)
            WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
            GROUP BY q.vec_id, c.vec_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
            FROM scores)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op7_url_filter": url_filter.judged_sql(URL_RULES),
    "op10_decontamination": r"""
        WITH item_words AS (
            SELECT item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        doc_words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        item_starts AS (
            SELECT item_id, w, least(len(w), 10) AS size,
                   unnest(range(1, len(w) - least(len(w), 10) + 2)) AS first
            FROM item_words WHERE len(w) > 0),
        item_windows AS (
            SELECT DISTINCT item_id, size, array_to_string(w[first:first + size - 1], ' ') AS passage
            FROM item_starts),
        sizes AS (SELECT DISTINCT size FROM item_windows),
        doc_starts AS (
            SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS first
            FROM doc_words, sizes WHERE len(w) >= size),
        doc_windows AS (
            SELECT doc_id, size, first, array_to_string(w[first:first + size - 1], ' ') AS passage
            FROM doc_starts),
        met AS (
            SELECT doc_id, first, size, item_id FROM doc_windows JOIN item_windows USING (size, passage)),
        places AS (SELECT DISTINCT doc_id, unnest(range(first, first + size)) AS place FROM met),
        hits AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
        found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_fingerprints": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   row_number() OVER (ORDER BY doc_id DESC) AS place, count(*) OVER () AS n
            FROM documents),
        edits AS (
            SELECT d.doc_id, d.text, e.doc_id AS next_id, length(d.text) AS n_chars,
                   substring(d.text, 1, length(d.text) - length(d.text) // 3)
                       || substring(e.text, 1, length(d.text) // 3) AS edited
            FROM docs d JOIN docs e ON e.place = d.place % d.n + 1),
        texts AS (
            SELECT doc_id, FALSE AS is_edit, text FROM edits UNION ALL SELECT doc_id, TRUE, edited FROM edits),
        bytes AS (
            SELECT doc_id, is_edit, CAST('0x' || unnest(digits) AS BIGINT) AS b, generate_subscripts(digits, 1) AS pos
            FROM (SELECT doc_id, is_edit, regexp_extract_all(hex(encode(text)), '..') AS digits FROM texts)),
        windows AS (
            SELECT doc_id, is_edit, b, coalesce(lead(b, 5) OVER w, 0) AS b5, coalesce(lead(b, 6) OVER w, 0) AS b6,
                   coalesce(lead(b, 7) OVER w, 0) AS b7, coalesce(lead(b, 12) OVER w, 0) AS b12,
                   coalesce(lead(b, 13) OVER w, 0) AS b13, coalesce(lead(b, 17) OVER w, 0) AS b17
            FROM bytes WINDOW w AS (PARTITION BY doc_id, is_edit ORDER BY pos)),
        triplets AS (
            SELECT doc_id, is_edit, unnest([
                (b * 2654435761 + b6 * 2246822507 + b12 * 3266489909) % 4294967296,
                (b * 2654435761 + b7 * 2246822507 + b17 * 3266489909 + 668265263) % 4294967296,
                (b * 2654435761 + b5 * 2246822507 + b13 * 3266489909 + 1336530526) % 4294967296]) AS t
            FROM windows),
        counted AS (
            SELECT doc_id, is_edit, ((xor(t, t >> 15) * 739982445) % 4294967296 >> 12) % 256 AS bucket, count(*) AS c
            FROM triplets GROUP BY ALL),
        buckets AS (
            SELECT doc_id, is_edit, list(coalesce(c, 0) ORDER BY bucket) AS counts, list_sort(counts) AS ordered
            FROM texts CROSS JOIN range(0, 256) AS all_buckets(bucket) LEFT JOIN counted USING (doc_id, is_edit, bucket)
            GROUP BY doc_id, is_edit),
        codes AS (
            SELECT doc_id, is_edit,
                   [CAST(c > ordered[64] AS INT) + CAST(c > ordered[128] AS INT) + CAST(c > ordered[192] AS INT) FOR c IN counts] AS codes,
                   CAST(least(round(ln(1 + octet_length(encode(text))) / ln(1.1)), 255) AS INT) AS size
            FROM buckets JOIN texts USING (doc_id, is_edit)),
        digests AS (
            SELECT *, lower(printf('%02x', size)) || list_aggregate([printf('%x', codes[2 * i + 1] * 4 + codes[2 * i + 2])
                                                           FOR i IN range(0, 128)], 'string_agg', '') AS digest
            FROM codes)
        SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, o.digest AS fingerprint, c.digest AS edited_fingerprint,
               1.0::DOUBLE - least(list_sum([abs(o.codes[i] - c.codes[i]) FOR i IN range(1, 257)])
                                   + 2 * least(abs(o.size - c.size), 32), 320)::DOUBLE / 320 AS near_edited,
               1.0::DOUBLE - least(list_sum([abs(o.codes[i] - f.codes[i]) FOR i IN range(1, 257)])
                                   + 2 * least(abs(o.size - f.size), 32), 320)::DOUBLE / 320 AS near_next
        FROM edits e JOIN digests o ON o.doc_id = e.doc_id AND NOT o.is_edit
        JOIN digests c ON c.doc_id = e.doc_id AND c.is_edit
        JOIN digests f ON f.doc_id = e.next_id AND NOT f.is_edit""",
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        parts AS (
            SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vectors),
        scores AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
            FROM parts a JOIN parts c USING (d)
            WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
            GROUP BY a.vec_id, c.vec_id, same),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op13_prefix_trie": """
        WITH own AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                                 ORDER BY turn NULLS FIRST,
                                          sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        hashed AS (
            SELECT conv_id, turns, xor(4294967295, list_reduce(
                list_prepend(4294967295, [ascii(c)::BIGINT FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
                lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::BIGINT FOR bit IN range(8)]),
                    lambda a, bit: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) % 9 AS h
            FROM own),
        rebuilt AS (
            SELECT o.conv_id, list_concat(coalesce(s.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
            FROM hashed o LEFT JOIN own s ON s.conv_id = o.conv_id - o.conv_id % 5),
        prefixes AS (
            SELECT conv_id, len(turns) AS n, d, turns[1:d] AS prefix
            FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
        nodes AS (
            SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(prefix[d].text) END AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
            FROM prefixes GROUP BY prefix, d),
        children AS (
            SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children
            FROM nodes WHERE d > 0 GROUP BY ALL),
        whole AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix, d)),
        subtrees AS (
            SELECT prefix[1:above] AS prefix, above AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT *, unnest(range(0, d + 1)) AS above FROM whole) GROUP BY ALL)
        SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
        FROM whole w JOIN subtrees USING (prefix, d)
        LEFT JOIN nodes p ON w.d > 0 AND p.d = w.d - 1 AND p.prefix = w.prefix[1:w.d - 1]""",
}
