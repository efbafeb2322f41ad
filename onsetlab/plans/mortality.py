"""From patient tables to training data, a model and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlab.functions.naming import feature_names
from onsetlab.operators.cohort import count_cohort
from onsetlab.operators.lookback import (
    LOOKBACK_DAYS,
    categorise,
    count_categories,
    joined_rows,
    lookback_events,
    top_category_names,
)
from onsetlab.operators.matrix import (
    GRAINS,
    INDEX_GRAIN,
    assemble_features,
    pivot_counts,
    pivot_index_counts,
)
from onsetlab.operators.boosting import BoostingOptions
from onsetlab.operators.model import Model, evaluate, save_model, score, train, train_second_order
from onsetlab.operators.split import SPLIT_WEIGHTS, split
from onsetlab.operators.vocabulary import condition_category_map, drug_category_map
from onsetlab.sources.sinks import read_dataset, write_dataset
from onsetlab.sources.staging import Stages


@dataclass(frozen=True)
class ClinicalTables:
    """The tables of one site, with dates normalised."""

    person: DataFrame
    observation_period: DataFrame
    death: DataFrame
    condition_occurrence: DataFrame
    drug_exposure: DataFrame
    condition_categories: DataFrame
    drug_categories: DataFrame

    @classmethod
    def from_vocabulary(
        cls, concept: DataFrame, concept_ancestor: DataFrame, **patient_tables: DataFrame
    ) -> ClinicalTables:
        return cls(
            condition_categories=condition_category_map(concept, concept_ancestor),
            drug_categories=drug_category_map(concept, concept_ancestor),
            **patient_tables,
        )


# The codes of ischaemic heart disease.
HEART_DISEASE_CODES = ("I20", "I21", "I22", "I23", "I24", "I25")


@dataclass(frozen=True)
class MortalityOptions:
    """What to predict and from what; see the operators for the meanings."""

    disease_codes: Sequence[str] = HEART_DISEASE_CODES
    min_history: int = 360
    min_followup: int = 360
    label_days: int = 360
    label: str = "within"
    followup: str = "as_written"
    onset: str = "every"
    lookback: tuple[int, int] = LOOKBACK_DAYS
    # The number of categories that count; None takes all that have a column.
    top: int | None = 10
    null_takes_slot: bool = True
    grain: str = "index"
    fill_cols: Sequence[str] | None = None
    weights: Sequence[float] = SPLIT_WEIGHTS
    # Column names by category, to fix the matrix's columns in advance. By
    # default there is one column for each top category.
    condition_columns: Mapping[str, str] | None = None
    drug_columns: Mapping[str, str] | None = None
    # Conditions are scanned for the cohort and again for the lookback. Where a
    # scan is costly (compressed text, a join), write the used columns once.
    stage_conditions: bool = False
    # Trees grown by gradients and Hessians, or Spark ML's ("spark_ml").
    trainer: str = "second_order"
    boosting: BoostingOptions = BoostingOptions()


def build_matrix(
    tables: ClinicalTables, options: MortalityOptions, stages: Stages
) -> tuple[DataFrame, MortalityOptions]:
    """The feature matrix with its keys, and the options with its columns filled in.

    Each large event table is scanned once per use: conditions for the cohort
    and for their lookback, drugs for theirs. What is used several times after
    that is staged: the category maps, the cohort, and the few events that lie
    in some lookback.
    """
    maps = {
        "condition": stages.stage(tables.condition_categories, "condition_categories"),
        "drug": stages.stage(tables.drug_categories, "drug_categories"),
    }
    conditions = tables.condition_occurrence
    if options.stage_conditions:
        used = conditions.select("person_id", "condition_concept_id", "condition_start_date")
        conditions = stages.stage(used, "conditions")
    cohort = stages.stage(
        count_cohort(
            conditions,
            tables.observation_period,
            tables.death,
            maps["condition"],
            disease_codes=options.disease_codes,
            min_history=options.min_history,
            min_followup=options.min_followup,
            label_days=options.label_days,
            label=options.label,
            followup=options.followup,
            onset=options.onset,
            deaths="summed",
        ),
        "cohort",
    )
    condition_counts, condition_columns = _wide_counts(
        cohort, conditions, "condition", "condition_start_date", maps["condition"],
        options, options.condition_columns, "cond_", stages,
    )
    drug_counts, drug_columns = _wide_counts(
        cohort, tables.drug_exposure, "drug", "drug_exposure_start_date", maps["drug"],
        options, options.drug_columns, "drug_", stages,
    )
    matrix = assemble_features(
        cohort,
        condition_counts,
        drug_counts,
        tables.person,
        grain=options.grain,
        fill_cols=options.fill_cols,
        keep_id=True,
        stages=stages,
    )
    return matrix, replace(
        options, condition_columns=condition_columns, drug_columns=drug_columns
    )


def _wide_counts(
    cohort: DataFrame,
    events: DataFrame,
    kind: str,
    date_col: str,
    categories: DataFrame,
    options: MortalityOptions,
    columns: Mapping[str, str] | None,
    prefix: str,
    stages: Stages,
) -> tuple[DataFrame, Mapping[str, str]]:
    category_col = f"{kind}_category"
    met = stages.stage(
        lookback_events(cohort, events, f"{kind}_concept_id", date_col, options.lookback),
        f"{kind}_lookback",
    )
    categorised = categorise(met, categories, category_col)
    if options.top is not None:
        rows = joined_rows(categorised, category_col)
        names = top_category_names(rows, category_col, options.top, options.null_takes_slot)
        if columns is None:
            columns = feature_names(prefix, names)
        if missing := sorted(set(names) - set(columns)):
            raise ValueError(f"top categories without a column: {', '.join(missing)}")
    elif columns is not None:
        names = list(columns)
    else:
        raise ValueError("give the columns, or the number of top categories")
    filled = {name: columns[name] for name in names}
    if options.grain == "index":
        wide = pivot_index_counts(cohort, categorised, category_col, filled, options.lookback)
    else:
        wide = pivot_counts(count_categories(categorised, category_col), category_col, filled)
    # Columns fixed in advance stay in the matrix; those outside the top are empty.
    empty = F.lit(None).cast("bigint")
    cells = [
        F.col(column) if name in filled else empty.alias(column)
        for name, column in columns.items()
    ]
    wide = wide.select(*GRAINS[options.grain], *cells)
    return wide, columns


@dataclass(frozen=True)
class MortalityRun:
    """What a finished job leaves behind."""

    train_path: str
    test_path: str
    model: Model
    # Where the model is saved, with its columns and these options.
    model_path: str
    metrics: DataFrame
    # The job's options, with the matrix's columns filled in.
    options: MortalityOptions


def run(
    spark: SparkSession,
    tables: ClinicalTables,
    output: str,
    options: MortalityOptions = MortalityOptions(),
    train_table: str | None = None,
    test_table: str | None = None,
) -> MortalityRun:
    """Build, split and write the datasets, then train and evaluate a model.

    The model is trained on the written training rows and evaluated on the
    written test rows, which hold other patients.
    """
    if len(options.weights) != 2:
        raise ValueError("a job has two weights, for training and test rows")
    if options.trainer not in ("second_order", "spark_ml"):
        raise ValueError(f"trainer must be second_order or spark_ml, not {options.trainer!r}")
    train_path, test_path = f"{output}/train", f"{output}/test"
    with Stages(spark) as stages:
        matrix, options = build_matrix(tables, options, stages)
        matrix = stages.stage(matrix, "matrix")
        keys = [c for c in INDEX_GRAIN if c in matrix.columns]
        parts = split(matrix, options.weights)
        for part, path, table in zip(parts, (train_path, test_path), (train_table, test_table)):
            # The matrix was staged with even partitions.
            write_dataset(part.drop(*keys), path, table, even=True)
        training = read_dataset(spark, train_path)
        if options.trainer == "second_order":
            model = train_second_order(training, options=options.boosting, stages=stages)
        else:
            model = train(training)
    model_path = f"{output}/model"
    save_model(spark, model, model_path, asdict(options))
    metrics = evaluate(model, read_dataset(spark, test_path))
    return MortalityRun(train_path, test_path, model, model_path, metrics, options)


def score_patients(
    model: Model, tables: ClinicalTables, options: MortalityOptions, stages: Stages
) -> DataFrame:
    """Risk of each cohort row of ``tables``, by its keys.

    ``options`` are those a finished run gives back: the matrix then has the
    model's columns, whatever is common among these patients. For patients whose
    follow-up still lies ahead set ``min_followup=-1``, which asks only that the
    onset is observed. The scores read from ``stages``: use them before it ends.
    """
    matrix, _ = build_matrix(tables, replace(options, top=None), stages)
    return score(model, matrix)
