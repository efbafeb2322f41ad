"""Verdicts on URLs: host and path rules first, then a weighted vocabulary.

The vocabulary is one Aho-Corasick automaton over strict and soft terms. A term
counts where no letter or digit touches it on either side. A URL is rejected
for one strict term, or for ``soft_hits`` different soft ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The vocabulary.
STRICT_TERMS = (
    "adult", "casino", "cheap-pills", "escort", "hentai", "jackpot", "malware", "phishing",
    "poker", "porn", "porno", "sexcam", "viagra", "warez", "xxx",
)
SOFT_TERMS = (
    "ads", "bet", "bets", "bonus", "cheap", "clicks", "dating", "deal", "discount", "farm",
    "free", "loan", "nude", "offer", "pills", "prize", "replica", "sex", "spam", "torrent",
    "track", "win",
)
SOFT_HITS = 2
#: A greater vocabulary is not copied to the tasks.
VOCABULARY_BYTES = 4 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, all its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path as they stand; both empty without ``://`` or URL."""
    known = F.coalesce(url.contains("://"), F.lit(False))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return (
        F.when(known, F.translate(host, _UPPER, _LOWER)).otherwise(empty),
        F.when(known, path).otherwise(empty),
    )


def rule_for(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Applied last, the longest rule stands before all others.
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict: Sequence[str], soft: Sequence[str]):
        self.automaton = ahocorasick.Automaton()
        for weight, terms in ((1, soft), (2, strict)):
            for term in filter(None, terms):
                self.automaton.add_word(term, (term, weight))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[list[str], list[str]]:
        """The different strict and soft terms of a text, each list in order."""
        found: dict[int, set[str]] = {1: set(), 2: set()}
        for last, (term, weight) in self.automaton.iter(text) if len(self.automaton) else ():
            first = last - len(term) + 1
            if not (first and _joins(text[first - 1])) and not (
                last + 1 < len(text) and _joins(text[last + 1])
            ):
                found[weight].add(term)
        return sorted(found[2]), sorted(found[1])


def weighted_terms(
    table: DataFrame, strict_from: float, term_col: str = "term", weight_col: str = "weight", max_bytes: int = VOCABULARY_BYTES
) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Strict and soft terms of a table of weighted terms, for ``judge_urls``.

    A term is strict from a weight of ``strict_from`` on and soft below it; one
    without a weight, or of a weight of 0 or less, is none. A-Z are lower-cased;
    of repeated terms the greatest weight holds; null and empty terms are left
    out. The automaton travels to every task, so a table of more than
    ``max_bytes`` of terms is refused, and nothing of it is collected.
    """
    term = F.translate(F.col(term_col).cast("string"), _UPPER, _LOWER)
    terms = (
        table.select(term.alias("term"), F.col(weight_col).cast("double").alias("weight"))
        .where("term <> '' AND weight > 0 AND NOT isnan(weight)")
        .groupBy("term")
        .agg(F.max("weight").alias("weight"))
    )
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"the vocabulary has {size} bytes of terms, more than {max_bytes}")
    rows = sorted((r["term"], r["weight"]) for r in terms.collect())
    strict = tuple(own for own, weight in rows if weight >= strict_from)
    return strict, tuple(own for own, weight in rows if weight < strict_from)


def _joins(char: str) -> bool:
    return char.isascii() and char.isalnum()


def judge_urls(
    df: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, strict and soft terms found.

    A null or empty URL has no rule and no term and is allowed. Terms are
    looked for in the whole URL, however long, with A-Z lower-cased. Repeated
    rows are judged each; an empty table gives no rows. Other columns are not
    read, whatever their names. Rules and terms are parameters, so their number
    is the caller's; they travel with the plan (``weighted_terms`` reads terms
    from a table). A term of both kinds is strict.
    """
    built: list[Vocabulary] = []

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not built:
            built.append(Vocabulary(strict, soft))
        for series in texts:
            found = [built[0].hits(text) for text in series]
            yield pd.DataFrame(
                {"strict": [f[0] for f in found], "soft": [f[1] for f in found]}
            )

    terms = F.pandas_udf(find, "strict array<string>, soft array<string>")
    url = F.col(url_col).cast("string")
    host, path = host_and_path(url)
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rejected = (F.size("found.strict") >= 1) | (F.size("found.soft") >= soft_hits)
    return (
        df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), url.alias("url"))
        .withColumn("found", terms(F.coalesce(F.translate("url", _UPPER, _LOWER), F.lit(""))))
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            text.alias("rule"),
            F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
            F.col("found.strict").alias("strict_terms"),
            F.col("found.soft").alias("soft_terms"),
        )
    )


def judged_sql(rules: Sequence[Rule]) -> str:
    """The same over ``pages``, in SQL with one search per term."""

    def count(terms: Sequence[str]) -> str:
        return " + ".join(
            f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INT)" for t in terms
        )

    order = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = lambda r: (
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    )
    texts = " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in order)
    verdicts = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in order)
    lower = f"translate(%s, '{_UPPER}', '{_LOWER}')"
    return rf"""
    WITH parts AS (
        SELECT page_id, coalesce({lower % 'url'}, '') AS low,
               CASE WHEN contains(url, '://') THEN {lower % "regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)"} ELSE '' END AS host,
               CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
        FROM pages)
    SELECT page_id, host, path, CASE {texts} END AS rule,
           CASE {verdicts}
                WHEN {count(STRICT_TERMS)} >= 1 OR {count(SOFT_TERMS)} >= {SOFT_HITS} THEN 'block'
                ELSE 'allow' END AS verdict
    FROM parts"""
