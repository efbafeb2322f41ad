"""Wide category counts and the training matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onsetlab.operators.cohort import ROW_COUNT, compact_cohort
from onsetlab.operators.lookback import CATEGORY_COUNT, LOOKBACK_DAYS
from onsetlab.operators.lookup import BROADCAST_BYTES, prefilter_keys
from onsetlab.operators.rows import expand_rows
from onsetlab.operators.sweep import covering_weight
from onsetlab.sources.staging import Stages, measured

PERSON_GRAIN = ["person_id"]
INDEX_GRAIN = ["person_id", "disease_start_date"]
GRAINS = {"person": PERSON_GRAIN, "index": INDEX_GRAIN}
# The demographic columns of a person.
DEMOGRAPHICS = ["gender_concept_id", "year_of_birth", "race_concept_id"]


def pivot_counts(
    counts: DataFrame, category_col: str, columns: Mapping[str, str]
) -> DataFrame:
    """Category counts side by side: one row per person, one column per category.

    ``columns`` maps the categories to column names; naming them up front saves
    the job that would discover them, and one aggregation on the person does
    the rest. A category that a person lacks is NULL; a person without any of
    the categories has no row.
    """
    cells = [
        F.sum(F.when(F.col(category_col) == category, F.col(CATEGORY_COUNT))).alias(name)
        for category, name in columns.items()
    ]
    wanted = F.col(category_col).isin(list(columns))
    return counts.filter(wanted).groupBy("person_id").agg(*cells)


def pivot_index_counts(
    cohort: DataFrame,
    categorised: DataFrame,
    category_col: str,
    columns: Mapping[str, str],
    lookback: tuple[int, int] = LOOKBACK_DAYS,
) -> DataFrame:
    """Category counts per person and onset day, side by side.

    Each onset sees its own lookback only, and cohort rows of the same day are
    not counted again. ``categorised`` comes from
    :func:`~onsetlab.operators.lookback.categorise` with the same ``lookback``.
    An event covers the onsets that look back on it, so the counts are running
    totals over the person's days. A category without events is 0.
    """
    nearest, farthest = lookback
    names = list(columns.values())
    cells = [
        F.when(F.col(category_col) == category, F.col("event_rows")).otherwise(0).alias(name)
        for category, name in columns.items()
    ]
    reach = categorised.filter(F.col(category_col).isin(list(columns))).select(
        "person_id",
        F.date_add("event_date", nearest).alias("lo"),
        F.date_add("event_date", farthest).alias("hi"),
        *cells,
    )
    index = cohort.select(*INDEX_GRAIN).distinct()
    return covering_weight(index, reach, "person_id", "disease_start_date", "lo", "hi", names)


def assemble_features(
    cohort: DataFrame,
    condition_counts: DataFrame,
    drug_counts: DataFrame,
    person: DataFrame,
    *,
    grain: str = "person",
    fill_cols: Sequence[str] | None = None,
    keep_id: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    stages: Stages | None = None,
) -> DataFrame:
    """Target, category counts and demographics, one row per cohort row.

    ``grain`` says what the two wide count frames are keyed by: ``"person"``
    (every row of a patient has the same counts, over all of the patient's
    onsets) or ``"index"`` (each onset day has its own). Missing numbers become
    0 in all numeric columns, or in ``fill_cols`` only. The keys are dropped
    unless ``keep_id``. The frames are joined while equal cohort rows are still
    counted. With ``stages`` the counted rows are staged first, which tells the
    largest count: the wide matrix is only shuffled again if some row stands for
    very many.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}, not {grain!r}")
    keys = GRAINS[grain]
    target = F.when(F.col("death_date").isNotNull(), 1).otherwise(0).alias("target")
    rows = (
        compact_cohort(cohort)
        .groupBy(*keys, target)
        .agg(F.sum(ROW_COUNT).alias(ROW_COUNT))
    )
    patients = cohort.select("person_id").distinct()
    demographics = (
        prefilter_keys(
            person.select("person_id", *DEMOGRAPHICS), patients, "person_id", max_bytes
        )
        .groupBy("person_id", *DEMOGRAPHICS)
        .agg(F.count("*").alias("person_rows"))
    )
    # The narrow frames first: wide rows are shuffled on the keys alone.
    narrow = (
        rows.join(demographics, "person_id", "left")
        .withColumn(ROW_COUNT, F.col(ROW_COUNT) * F.coalesce("person_rows", F.lit(1)))
        .drop("person_rows")
    )
    most = None
    if stages is not None:
        narrow = stages.stage(narrow, "matrix_rows", F.max(ROW_COUNT).alias("most"))
        most = measured(narrow)["most"] or 0
    wide = narrow.join(condition_counts, keys, "left").join(drug_counts, keys, "left")
    count_columns = [
        c for df in (condition_counts, drug_counts) for c in df.columns if c not in keys
    ]
    wide = wide.select(*keys, "target", *count_columns, *DEMOGRAPHICS, ROW_COUNT)
    # Keys are not features: a missing one stays missing.
    filled = [*count_columns, *DEMOGRAPHICS] if fill_cols is None else list(fill_cols)
    wide = wide.fillna(0, subset=filled) if filled else wide
    matrix = expand_rows(wide, ROW_COUNT, spread=[*keys, "target"], most=most)
    # The label leads, as single-table trainers expect.
    ordered = ["target", *count_columns, *DEMOGRAPHICS]
    return matrix.select(*(keys if keep_id else []), *ordered)
