"""Roll-up of concepts to named categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onsetlab.operators.lookup import BROADCAST_BYTES, lookup_join

# Vocabulary, concept class and domain that name the categories.
CONDITION_CATEGORIES = {
    "vocabulary_id": "ICD10",
    "concept_class_id": "ICD10 Hierarchy",
    "domain_id": "Condition",
}
DRUG_CATEGORIES = {
    "vocabulary_id": "ATC",
    "concept_class_id": "ATC 2nd",
    "domain_id": "Drug",
}


def category_map(
    concept: DataFrame,
    concept_ancestor: DataFrame,
    vocabulary_id: str,
    concept_class_id: str,
    domain_id: str,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every concept below the ancestors of one vocabulary, class and domain.

    One row per ancestor and descendant: ``ancestor_concept_id,
    ancestor_concept_name, ancestor_concept_code, descendant_concept_id``.
    """
    ancestors = concept.filter(
        (F.col("vocabulary_id") == vocabulary_id)
        & (F.col("concept_class_id") == concept_class_id)
        & (F.col("domain_id") == domain_id)
    ).select(
        F.col("concept_id").alias("ancestor_concept_id"),
        F.col("concept_name").alias("ancestor_concept_name"),
        F.col("concept_code").alias("ancestor_concept_code"),
    )
    closure = concept_ancestor.select("ancestor_concept_id", "descendant_concept_id")
    return lookup_join(
        closure,
        ancestors,
        on="ancestor_concept_id",
        how="inner",
        spread=["descendant_concept_id"],
        max_bytes=max_bytes,
    ).select(
        "ancestor_concept_id",
        "ancestor_concept_name",
        "ancestor_concept_code",
        "descendant_concept_id",
    )


def condition_category_map(concept: DataFrame, concept_ancestor: DataFrame) -> DataFrame:
    return category_map(concept, concept_ancestor, **CONDITION_CATEGORIES)


def drug_category_map(concept: DataFrame, concept_ancestor: DataFrame) -> DataFrame:
    return category_map(concept, concept_ancestor, **DRUG_CATEGORIES)
