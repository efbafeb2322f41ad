"""Patients at the onset of a disease, with enough observation around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from onsetlab.functions.dates import day_number
from onsetlab.operators.lookup import BROADCAST_BYTES, lookup_join
from onsetlab.operators.rows import expand_rows
from onsetlab.operators.sweep import covering_weight
from onsetlab.sources.staging import measured

COHORT_COLUMNS = ["person_id", "disease_concept_id", "disease_start_date", "death_date"]
ROW_COUNT = "row_count"


def cohort_members(
    condition_occurrence: DataFrame,
    categories: DataFrame,
    *,
    disease_codes: Sequence[str] | None = None,
    disease_ids: Sequence[int] | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Occurrences of any concept below the chosen disease categories.

    Categories are chosen by code or by concept id. An occurrence appears once
    however many chosen ancestors its concept has.
    """
    if (disease_codes is None) == (disease_ids is None):
        raise ValueError("give either disease_codes or disease_ids")
    if disease_codes is not None:
        chosen = F.col("ancestor_concept_code").isin(list(disease_codes))
    else:
        chosen = F.col("ancestor_concept_id").isin(list(disease_ids))
    concepts = (
        categories.filter(chosen)
        .select(F.col("descendant_concept_id").alias("condition_concept_id"))
        .distinct()
    )
    return lookup_join(
        condition_occurrence.select(
            "person_id", "condition_concept_id", "condition_start_date"
        ),
        concepts,
        on="condition_concept_id",
        how="left_semi",
        spread=["person_id", "condition_start_date"],
        max_bytes=max_bytes,
        at_most=categories if measured(categories) else None,
    ).select("person_id", "condition_concept_id", "condition_start_date")


def count_cohort(
    condition_occurrence: DataFrame,
    observation_period: DataFrame,
    death: DataFrame,
    categories: DataFrame,
    *,
    disease_codes: Sequence[str] | None = None,
    disease_ids: Sequence[int] | None = None,
    min_history: int = 360,
    min_followup: int = 360,
    label_days: int = 360,
    label: str = "within",
    followup: str = "as_written",
    onset: str = "every",
    deaths: str = "each",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The cohort of :func:`select_cohort` with equal rows counted.

    The columns are those of the cohort and ``row_count``. Everything up to
    here works on counts, so a person whose occurrences repeat without bound
    still has at most one row per concept, onset day and death day.

    With ``deaths="summed"`` there is one row per concept and onset day: its
    ``death_date`` is the earliest that labels it and ``row_count`` stands for
    the rows of all of them. Whatever only needs the target and the number of
    rows is the same, and a label that attaches any number of deaths to any
    number of onsets (``as_written``) makes no pairs of them.
    """
    _one_of("label", label, ("within", "as_written"))
    _one_of("deaths", deaths, ("each", "summed"))
    _one_of("followup", followup, ("as_written", "or_death"))
    _one_of("onset", onset, ("every", "first"))
    if followup == "or_death" and label != "within":
        raise ValueError("followup='or_death' needs the label 'within'")

    members = cohort_members(
        condition_occurrence,
        categories,
        disease_codes=disease_codes,
        disease_ids=disease_ids,
        max_bytes=max_bytes,
    ).filter(F.col("person_id").isNotNull() & F.col("condition_start_date").isNotNull())
    if onset == "first":
        earliest = F.min(F.struct("condition_start_date", "condition_concept_id"))
        onsets = (
            members.groupBy("person_id")
            .agg(earliest.alias("earliest"))
            .select(
                "person_id",
                F.col("earliest.condition_concept_id").alias("disease_concept_id"),
                F.col("earliest.condition_start_date").alias("disease_start_date"),
                F.lit(1).cast("bigint").alias("occurrences"),
            )
        )
    else:
        onsets = members.groupBy(
            "person_id",
            F.col("condition_concept_id").alias("disease_concept_id"),
            F.col("condition_start_date").alias("disease_start_date"),
        ).agg(F.count("*").alias("occurrences"))

    # A period admits the onsets between its start plus the history and its end
    # less the follow-up. With ``or_death`` it admits later ones up to its end,
    # if the patient dies within the label's days.
    start = F.date_add("observation_period_start_date", min_history + 1)
    end = F.col("observation_period_end_date")
    followed = observation_period.select(
        "person_id",
        start.alias("lo"),
        F.date_sub(end, min_followup + 1).alias("hi"),
        F.lit(1).alias("followed"),
        F.lit(0).alias("observed"),
    )
    weights = ["followed"]
    if followup == "or_death":
        observed = observation_period.select(
            "person_id",
            start.alias("lo"),
            end.alias("hi"),
            F.lit(0).alias("followed"),
            F.lit(1).alias("observed"),
        )
        followed = followed.unionByName(observed)
        weights.append("observed")
    covered = covering_weight(
        onsets, followed, "person_id", "disease_start_date", "lo", "hi", weights
    ).filter(" OR ".join(f"{weight} > 0" for weight in weights))

    days = death.groupBy(F.col("person_id").alias("dead_person_id"), "death_date").agg(
        F.count("*").alias("death_rows")
    )
    if label == "as_written" and (deaths == "summed" or onset == "first"):
        labelled = _with_earlier_deaths(covered, days, label_days)
    else:
        if label == "within":
            counts = F.datediff("death_date", "disease_start_date").between(0, label_days)
        else:
            counts = F.datediff("disease_start_date", "death_date") > label_days
        # The day distance belongs to the join condition: as a filter it would drop
        # the survivors.
        labelled = covered.join(
            days, (F.col("person_id") == F.col("dead_person_id")) & counts, "left"
        )
    periods = F.col("followed")
    if followup == "or_death":
        periods = F.when(F.col("death_date").isNotNull(), F.col("observed")).otherwise(periods)
    cohort = labelled.select(
        *COHORT_COLUMNS,
        (F.col("occurrences") * periods * F.coalesce("death_rows", F.lit(1))).alias(ROW_COUNT),
    ).filter(F.col(ROW_COUNT) > 0)
    if onset == "first":
        # One row per patient, whatever the number of periods and death records.
        cohort = cohort.groupBy(*COHORT_COLUMNS[:3]).agg(
            F.min("death_date").alias("death_date"),
            F.lit(1).cast("bigint").alias(ROW_COUNT),
        )
    elif deaths == "summed":
        cohort = cohort.groupBy(*COHORT_COLUMNS[:3]).agg(
            F.min("death_date").alias("death_date"), F.sum(ROW_COUNT).alias(ROW_COUNT)
        )
    return cohort


def _with_earlier_deaths(onsets: DataFrame, days: DataFrame, label_days: int) -> DataFrame:
    """Each onset's number of death records more than ``label_days`` before it, and the first of them.

    Death days are merged into the person's onsets at the first day they label;
    a running total over the days gives the number, without pairs. An onset
    without such a death has NULL in both columns.
    """
    marks = days.filter("death_date IS NOT NULL").select(
        F.col("dead_person_id").alias("person_id"),
        (day_number("death_date") + label_days + 1).alias("_day"),
        "death_date",
        "death_rows",
    )
    until_day = (
        Window.partitionBy("person_id")
        .orderBy("_day")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = onsets.select(
        "*", day_number("disease_start_date").alias("_day"), F.lit(True).alias("_onset")
    ).unionByName(marks, allowMissingColumns=True)
    return merged.select(
        *onsets.columns,
        "_onset",
        F.min("death_date").over(until_day).alias("death_date"),
        F.sum("death_rows").over(until_day).alias("death_rows"),
    ).filter("_onset").drop("_onset")


def select_cohort(
    condition_occurrence: DataFrame,
    observation_period: DataFrame,
    death: DataFrame,
    categories: DataFrame,
    **options,
) -> DataFrame:
    """Disease onsets with the required observation, and the labelling death.

    One row per occurrence, admitting observation period and labelling death:
    ``person_id, disease_concept_id, disease_start_date, death_date``. Options:

    ``disease_codes`` or ``disease_ids``
        the categories that make up the disease;
    ``min_history``, ``min_followup``
        an onset counts if more than this many days of the same period lie
        before and after it;
    ``label``
        ``"within"`` attaches a death 0 to ``label_days`` days after onset,
        ``"as_written"`` one that lies more than ``label_days`` days before it;
    ``followup``
        ``"or_death"`` also admits patients whose observation ends early
        because they die within the label's days;
    ``onset``
        ``"first"`` keeps each patient's earliest occurrence only.

    The rows are the literal ones: ``as_written`` pairs every onset of a person
    with every death that labels it. :func:`count_cohort` has a form without.
    """
    if options.get("deaths", "each") != "each":
        raise ValueError("the rows of a cohort name each death")
    compact = count_cohort(
        condition_occurrence, observation_period, death, categories, **options
    )
    return expand_rows(compact, ROW_COUNT)


def compact_cohort(cohort: DataFrame) -> DataFrame:
    """A cohort in counted form, whether it is given row by row or counted."""
    if ROW_COUNT in cohort.columns:
        return cohort
    return cohort.groupBy(*cohort.columns).agg(F.count("*").alias(ROW_COUNT))


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")
