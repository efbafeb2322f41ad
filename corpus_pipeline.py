"""Documents made ready for training, stage by stage.

Each stage takes all that the one before kept. Texts that are too poor go, one
document of each group of near copies stays, passages that an earlier document
has are cut out, documents with passages of the benchmark go, and what is left
becomes token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlab.llm import byte_bpe, decontaminate, jaccard_join, quality, repeats
from onsetlab.llm.scratch import cut
from onsetlab.llm.shipping import ship
from onsetlab.operators.lookup import fits_broadcast

#: A document stays if its text is good with this probability or more.
LEAST_QUALITY = 0.3


def _whole_row(docs: DataFrame) -> Column:
    """All columns in one, where a new column cannot have the name of one of them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, does not reject."""
    ship(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.with_quality(docs.select("text", _whole_row(docs)), model, name="score")
    return scored.where(F.col("score") >= LEAST_QUALITY).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; null ids stay."""
    ship(spark)
    linked = jaccard_join.link_documents(docs)
    others = cut(linked.where("doc_id <> component_id").select("doc_id").distinct())
    # Only ids that fit are copied to the tasks; beyond that texts are shuffled to them.
    gone = F.broadcast(others) if fits_broadcast(others) else others
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that start in an earlier document; whole characters only."""
    ship(spark)
    kept = [c for c in docs.columns if c != "text"]
    parts = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("text").isNull().alias("absent"))
    less = repeats.remove_repeats(parts, characters=True)
    # A text of which nothing went stays as it was, null or empty included.
    shorter = less.select("row", F.size("removed").alias("gone"), F.when(~F.col("absent"), F.decode("kept", "UTF-8")).alias("text"))
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if "n_chars" in kept:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns[docs.columns.index("n_chars")] = F.when(F.col("gone") > 0, counted).otherwise(F.col("row.n_chars")).alias("n_chars")
    return shorter.select(*columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    ship(spark)
    parts = docs.select("doc_id", "text", _whole_row(docs))
    found = decontaminate.find_contamination(parts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("found.items") == 0).select("row.*")


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and whether they decode to the text."""
    ship(spark)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, ranks)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE encoding and decoding", tokenised),
]

#: No stage of a learned model or of links over many steps has a plain SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        # A stage reads its documents more than once, so each result is written down.
        docs = stage(spark, cut(docs) if number else docs, sf_dir)
    return docs
