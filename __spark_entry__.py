"""Registered queries and the SQL each of them must agree with.

The queries read the clinical views that ``onsetlab.sources.star_fixture``
derives from the test tables. The SQL states what a query means in the plainest
way (joins of rows with rows); the queries themselves work on counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlab.functions.naming import feature_names
from onsetlab.operators import cohort as cohorts
from onsetlab.operators import lookback as lookbacks
from onsetlab.operators import boosting, matrix, model, split, vocabulary
from onsetlab.operators.boosting import BoostingOptions
from onsetlab.plans import mortality
from onsetlab.sources import sinks, staging, star_fixture, tables
from onsetlab.sources.contracts import CONTRACTS, check_contract

SMALL_DATA = "/root/testdata/sf0.001"
DISEASE = ("B01", "B02")
# All categories the fixture's vocabulary can name, so that wide results have
# the same columns at every scale.
CONDITION_COLUMNS = feature_names(
    "cond_", [f"Brand#{b}" for b in range(1, 26)] + [f"Chapter {c}" for c in range(5)]
)
DRUG_COLUMNS = feature_names("drug_", [f"NATION_{n}" for n in range(25)])
OPTIONS = mortality.MortalityOptions(
    disease_codes=DISEASE,
    condition_columns=CONDITION_COLUMNS,
    drug_columns=DRUG_COLUMNS,
    # Here an event table is a join of two others.
    stage_conditions=True,
)
EVENTS = {
    "condition": ("condition_occurrence", "condition_concept_id", "condition_start_date"),
    "drug": ("drug_exposure", "drug_concept_id", "drug_exposure_start_date"),
}


class Clinic:
    """The fixture's tables, and the intermediates several queries share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.views = star_fixture.StarFixture(spark, folder)

    @cached_property
    def stages(self) -> staging.Stages:
        """The session's: queries return lazy frames that read what they staged."""
        return staging.session_stages(self.spark)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.stages.stage(df, name)

    @cached_property
    def condition_map(self) -> DataFrame:
        return self.stage(self.plain_map("condition"), "condition_map")

    @cached_property
    def drug_map(self) -> DataFrame:
        return self.stage(self.plain_map("drug"), "drug_map")

    def plain_map(self, kind: str) -> DataFrame:
        build = {
            "condition": vocabulary.condition_category_map,
            "drug": vocabulary.drug_category_map,
        }[kind]
        return build(self.views["concept"], self.views["concept_ancestor"])

    def cohort_inputs(self) -> tuple[DataFrame, ...]:
        return (
            self.views["condition_occurrence"],
            self.views["observation_period"],
            self.views["death"],
            self.condition_map,
        )

    @cached_property
    def cohort(self) -> DataFrame:
        compact = cohorts.count_cohort(*self.cohort_inputs(), disease_codes=DISEASE)
        return self.stage(compact, "cohort")

    def categorised(self, kind: str) -> DataFrame:
        table, concept_col, date_col = EVENTS[kind]
        met = lookbacks.lookback_events(self.cohort, self.views[table], concept_col, date_col)
        categories = self.condition_map if kind == "condition" else self.drug_map
        return lookbacks.categorise(met, categories, f"{kind}_category")

    def staged_counts(self, kind: str) -> DataFrame:
        counts = lookbacks.count_categories(self.categorised(kind), f"{kind}_category")
        return self.stage(counts, f"{kind}_counts")

    def tables(self) -> mortality.ClinicalTables:
        return mortality.ClinicalTables.from_vocabulary(
            self.views["concept"],
            self.views["concept_ancestor"],
            person=self.views["person"],
            observation_period=self.views["observation_period"],
            death=self.views["death"],
            condition_occurrence=self.views["condition_occurrence"],
            drug_exposure=self.views["drug_exposure"],
        )

    def features(self, **changes) -> DataFrame:
        """The matrix with its keys."""
        features, _ = mortality.build_matrix(self.tables(), replace(OPTIONS, **changes), self.stages)
        return features


def entry(spark: SparkSession) -> DataFrame:
    """The feature matrix of the small test data."""
    return features_person(Clinic(spark, SMALL_DATA))


# Sources and contracts


def landing_dates(clinic: Clinic) -> DataFrame:
    return tables.patient_table(clinic.views["landing_condition"])


def _contract(table: str, df: DataFrame) -> T.StructType:
    return T.StructType([CONTRACTS[table][name] for name in df.columns])


def vocabulary_csv(clinic: Clinic) -> DataFrame:
    """Landed as plain CSV, read back with the table's contract."""
    concept = clinic.views["concept"]
    path = clinic.stages.path("concept_csv")
    concept.write.option("header", "true").csv(path)
    return tables.read_landing_csv(clinic.spark, path, _contract("concept", concept))


def _landed(view: str) -> Callable[[Clinic], DataFrame]:
    """A patient table landed as bzip2 CSV, read back by its contract, dates cast."""
    table = LANDED[view]

    def build(clinic: Clinic) -> DataFrame:
        landed = clinic.views[view]
        path = clinic.stages.path(f"{view}_csv_bz2")
        landed.write.option("header", "true").option("compression", "bzip2").csv(path)
        contract = _contract(table, landed)
        return tables.patient_table(tables.read_landing_csv(clinic.spark, path, contract))

    return build


def landing_rejects(clinic: Clinic) -> DataFrame:
    """Conditions landed with planted faults: the rows that are good, and the records that are not, with reasons."""
    landed = clinic.views["landing_condition"]
    contract = _contract("condition_occurrence", landed)
    whole = F.to_csv(F.struct(*landed.columns))
    cut = F.to_csv(F.struct(*landed.columns[:-1]))
    planted = F.col("person_id") % 11
    line = F.when(planted == 3, cut).when(planted == 7, F.concat(whole, F.lit(",more"))).otherwise(whole)
    path = clinic.stages.path("condition_lines")
    landed.select(line).write.option("compression", "bzip2").text(path)
    read = tables.read_landing_with_rejects(clinic.spark, path, contract, stages=clinic.stages, header="false")
    rejects = read.rejects.select("record", F.array_join("reasons", ", ").alias("reasons"))
    return tables.patient_table(read.rows).unionByName(rejects, allowMissingColumns=True)


LANDED = {
    "landing_condition": "condition_occurrence",
    "landing_drug": "drug_exposure",
    "landing_death": "death",
    "landing_period": "observation_period",
    "landing_person": "person",
}
CHECKED = {**{table: view for view, table in LANDED.items()}, "concept": "concept", "concept_ancestor": "concept_ancestor"}


def contract_check(clinic: Clinic) -> DataFrame:
    """All seven contracts, on tables with planted faults."""
    checks = [check_contract(clinic.views[view], CONTRACTS[table], table) for table, view in CHECKED.items()]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def query_view(clinic: Clinic) -> DataFrame:
    """A parameterised query over registered views, itself registered."""
    clinic.views["condition_occurrence"].createOrReplaceTempView("onsetlab_conditions")
    clinic.condition_map.createOrReplaceTempView("onsetlab_categories")
    return tables.create_query_view(
        clinic.spark,
        "onsetlab_disease_days",
        """
        SELECT condition_start_date, count(*) AS occurrences
        FROM onsetlab_conditions LEFT SEMI JOIN onsetlab_categories
          ON condition_concept_id = descendant_concept_id
         AND array_contains(:codes, ancestor_concept_code)
        GROUP BY condition_start_date
        """,
        {"codes": list(DISEASE)},
    )


# Cohort


def cohort_members(clinic: Clinic) -> DataFrame:
    return cohorts.cohort_members(
        clinic.views["condition_occurrence"], clinic.condition_map, disease_codes=DISEASE
    )


def _cohort(**options) -> Callable[[Clinic], DataFrame]:
    def build(clinic: Clinic) -> DataFrame:
        chosen = options if "disease_ids" in options else {"disease_codes": DISEASE, **options}
        return cohorts.select_cohort(*clinic.cohort_inputs(), **chosen)

    return build


def cohort_targets(clinic: Clinic) -> DataFrame:
    """Target and number of rows per onset under the literal label, without pairing onsets and deaths."""
    counted = cohorts.count_cohort(*clinic.cohort_inputs(), disease_codes=DISEASE, label="as_written", deaths="summed")
    return counted.withColumnRenamed("death_date", "first_death_date")


# Features


def _lookback(kind: str) -> Callable[[Clinic], DataFrame]:
    table, concept_col, date_col = EVENTS[kind]

    def build(clinic: Clinic) -> DataFrame:
        return lookbacks.lookback_categories(
            clinic.cohort,
            clinic.views[table],
            concept_col,
            date_col,
            clinic.condition_map if kind == "condition" else clinic.drug_map,
            f"{kind}_category",
        )

    return build


def _top(kind: str, **options) -> Callable[[Clinic], DataFrame]:
    def build(clinic: Clinic) -> DataFrame:
        rows = lookbacks.joined_rows(clinic.categorised(kind), f"{kind}_category")
        return lookbacks.top_categories(rows, f"{kind}_category", **options)

    return build


def _common(kind: str) -> Callable[[Clinic], DataFrame]:
    return lambda clinic: lookbacks.common_categories(
        clinic.staged_counts(kind), f"{kind}_category"
    )


def _counts(kind: str) -> Callable[[Clinic], DataFrame]:
    return lambda clinic: lookbacks.restrict_to_top(
        clinic.staged_counts(kind), f"{kind}_category"
    )


def _pivot(kind: str) -> Callable[[Clinic], DataFrame]:
    columns = CONDITION_COLUMNS if kind == "condition" else DRUG_COLUMNS

    def build(clinic: Clinic) -> DataFrame:
        common = lookbacks.restrict_to_top(clinic.staged_counts(kind), f"{kind}_category")
        return matrix.pivot_counts(common, f"{kind}_category", columns)

    return build


def features_person(clinic: Clinic) -> DataFrame:
    return clinic.features(grain="person").drop(*matrix.PERSON_GRAIN)


def features_index(clinic: Clinic) -> DataFrame:
    return clinic.features(grain="index")


def features_first_onset(clinic: Clinic) -> DataFrame:
    return clinic.features(grain="index", onset="first", followup="or_death")


def features_as_written(clinic: Clinic) -> DataFrame:
    return clinic.features(grain="index", label="as_written")


# Datasets and model


def split_assignment(clinic: Clinic) -> DataFrame:
    keys = clinic.stage(
        clinic.features(grain="index").select(*matrix.INDEX_GRAIN, "target"), "split_keys"
    )
    training, test = split.split(keys)
    return training.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def dataset_roundtrip(clinic: Clinic) -> DataFrame:
    path = clinic.stages.path("dataset")
    sinks.write_dataset(features_person(clinic), path, even=True)
    return sinks.read_dataset(clinic.spark, path)


def replaced_dataset(clinic: Clinic) -> DataFrame:
    """A dataset after a write that failed half way: its rows are those from before."""
    path = clinic.stages.path("replaced")
    rows = features_person(clinic)
    sinks.write_dataset(rows, path, even=True)
    broken = rows.withColumn("target", F.expr("CASE WHEN target = 1 THEN raise_error('broken row') ELSE target END").cast("int"))
    try:
        sinks.write_dataset(broken, path, even=True)
    except Exception as e:  # noqa: BLE001  the engine's own error, which class it is depends on where it arises
        if "broken row" not in str(e):
            raise
    return sinks.read_dataset(clinic.spark, path)


#: Two stumps: what their SQL says in one step each.
STUMPS = BoostingOptions(rounds=2, max_depth=1, subsample=1.0, gamma=0.05, min_child_weight=1.0)
STUMP_FEATURES = [*CONDITION_COLUMNS.values(), *DRUG_COLUMNS.values(), *matrix.DEMOGRAPHICS]


def boosted_scores(clinic: Clinic) -> DataFrame:
    """Risks by two second-order stumps grown on the whole matrix, after the model was saved and read again."""
    rows = clinic.stage(clinic.features(grain="index"), "matrix")
    grown = model.train_second_order(rows, STUMP_FEATURES, STUMPS, clinic.stages)
    path = clinic.stages.path("model")
    model.save_model(clinic.spark, grown, path)
    scored = model.load_model(clinic.spark, path).score(rows)
    return scored.withColumn("risk", F.round("risk", 9))


def _trained(clinic: Clinic) -> tuple[model.PipelineModel, DataFrame, DataFrame]:
    rows = clinic.stage(clinic.features(grain="index"), "matrix")
    training, test = split.split(rows)
    return model.train(training), rows, test


def risk_scores(clinic: Clinic) -> DataFrame:
    fitted, rows, _ = _trained(clinic)
    return model.score(fitted, rows)


def model_metrics(clinic: Clinic) -> DataFrame:
    fitted, _, test = _trained(clinic)
    return model.evaluate(fitted, test)


# A score of the keys alone, with many ties and more than a thousand values at scale.
FORMULA_SCORE = "(7919 * person_id + 31 * year(disease_start_date) + 17 * month(disease_start_date)) % 1511 / 1510.0D"


def metrics_of_scores(clinic: Clinic) -> DataFrame:
    """Confusion counts and curve areas of a formula score, against the cohort's labels."""
    rows = clinic.features(grain="index").select("target", F.expr(FORMULA_SCORE).alias("risk"))
    return model.score_metrics(rows).select("name", F.round("value", 9).alias("value"))


def score_rows(clinic: Clinic) -> DataFrame:
    """The keys that the trained model scores, and whether each risk is a probability."""
    return risk_scores(clinic).select(
        "person_id", "disease_start_date", F.col("risk").between(0, 1).alias("is_probability")
    )


QUERIES: dict[str, Callable[[Clinic], DataFrame]] = {
    "landing_dates": landing_dates,
    "patient_csv": _landed("landing_condition"),
    "drug_csv": _landed("landing_drug"),
    "death_csv": _landed("landing_death"),
    "period_csv": _landed("landing_period"),
    "person_csv": _landed("landing_person"),
    "vocabulary_csv": vocabulary_csv,
    "landing_rejects": landing_rejects,
    "contract_check": contract_check,
    "query_view": query_view,
    "condition_category_map": lambda clinic: clinic.plain_map("condition"),
    "drug_category_map": lambda clinic: clinic.plain_map("drug"),
    "cohort_members": cohort_members,
    "cohort": _cohort(),
    "cohort_by_id": _cohort(disease_ids=[3000001, 3000002]),
    "cohort_as_written": _cohort(label="as_written"),
    "cohort_targets": cohort_targets,
    "cohort_or_death": _cohort(followup="or_death"),
    "cohort_first_onset": _cohort(onset="first"),
    "condition_lookback": _lookback("condition"),
    "drug_lookback": _lookback("drug"),
    "top_conditions": _top("condition"),
    "top_drugs": _top("drug"),
    "top_named_conditions": _top("condition", null_takes_slot=False),
    "common_conditions": _common("condition"),
    "common_drugs": _common("drug"),
    "condition_counts": _counts("condition"),
    "drug_counts": _counts("drug"),
    "condition_pivot": _pivot("condition"),
    "drug_pivot": _pivot("drug"),
    "features_person": features_person,
    "features_index": features_index,
    "features_first_onset": features_first_onset,
    "features_as_written": features_as_written,
    "split_assignment": split_assignment,
    "dataset_roundtrip": dataset_roundtrip,
    "replaced_dataset": replaced_dataset,
    "boosted_scores": boosted_scores,
    "metrics_of_scores": metrics_of_scores,
    "score_rows": score_rows,
    "risk_scores": risk_scores,
    "model_metrics": model_metrics,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def register(build: Callable[[Clinic], DataFrame]):
        return lambda spark, folder: build(Clinic(spark, folder))

    return {name: register(build) for name, build in QUERIES.items()} | _text_queries()[0]


def _text_queries() -> tuple[dict, dict]:
    """Queries and SQL of the text subpackage, where it can be imported."""
    try:
        import corpus_pipeline
        from onsetlab.llm import queries as text_queries
    except ImportError:
        return {}, {}
    registered = {**text_queries.QUERIES, "pipeline": corpus_pipeline.run}
    oracles = dict(text_queries.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return registered, oracles


# The same results in SQL. Each step may use the views and the steps above it.
STEPS: dict[str, str] = {
    "condition_map": """
        SELECT ancestor_concept_id, concept_name AS ancestor_concept_name,
               concept_code AS ancestor_concept_code, descendant_concept_id
        FROM concept_ancestor, concept
        WHERE concept_id = ancestor_concept_id AND vocabulary_id = 'ICD10'
          AND concept_class_id = 'ICD10 Hierarchy' AND domain_id = 'Condition'""",
    "drug_map": """
        SELECT ancestor_concept_id, concept_name AS ancestor_concept_name,
               concept_code AS ancestor_concept_code, descendant_concept_id
        FROM concept_ancestor, concept
        WHERE concept_id = ancestor_concept_id AND vocabulary_id = 'ATC'
          AND concept_class_id = 'ATC 2nd' AND domain_id = 'Drug'""",
    "members": """
        SELECT person_id, condition_concept_id, condition_start_date
        FROM condition_occurrence o
        WHERE EXISTS (SELECT 1 FROM condition_map m
                      WHERE m.descendant_concept_id = o.condition_concept_id
                        AND m.ancestor_concept_code IN ('B01', 'B02'))""",
    "observed": """
        SELECT m.person_id, condition_concept_id AS disease_concept_id,
               condition_start_date AS disease_start_date,
               observation_period_end_date - condition_start_date AS days_after
        FROM members m, observation_period p
        WHERE m.person_id = p.person_id
          AND condition_start_date - observation_period_start_date > 360""",
    "cohort": """
        SELECT o.person_id, disease_concept_id, disease_start_date, death_date
        FROM observed o LEFT JOIN death d
          ON d.person_id = o.person_id AND death_date - disease_start_date BETWEEN 0 AND 360
        WHERE days_after > 360""",
    "cohort_as_written": """
        SELECT o.person_id, disease_concept_id, disease_start_date, death_date
        FROM observed o LEFT JOIN death d
          ON d.person_id = o.person_id AND disease_start_date - death_date > 360
        WHERE days_after > 360""",
    "cohort_or_death": """
        SELECT o.person_id, disease_concept_id, disease_start_date, death_date
        FROM observed o LEFT JOIN death d
          ON d.person_id = o.person_id AND death_date - disease_start_date BETWEEN 0 AND 360
        WHERE days_after > 360 OR (days_after >= 0 AND death_date IS NOT NULL)""",
    "first_members": """
        SELECT person_id, disease_concept_id, disease_start_date
        FROM (SELECT person_id, condition_concept_id AS disease_concept_id,
                     condition_start_date AS disease_start_date,
                     row_number() OVER (PARTITION BY person_id
                       ORDER BY condition_start_date, condition_concept_id) AS position
              FROM members) WHERE position = 1""",
    "cohort_first_onset": """
        SELECT DISTINCT person_id, disease_concept_id, disease_start_date, death_date
        FROM cohort JOIN first_members USING (person_id, disease_concept_id, disease_start_date)""",
    "first_or_death": """
        SELECT DISTINCT person_id, disease_concept_id, disease_start_date, death_date
        FROM cohort_or_death
        JOIN first_members USING (person_id, disease_concept_id, disease_start_date)""",
}


def _with(step: str) -> str:
    """The steps up to and including ``step``, after the views."""
    names = list(STEPS)
    steps = [f"{name} AS ({STEPS[name]})" for name in names[: names.index(step) + 1]]
    views = [v for v in star_fixture.VIEWS if not v.startswith("landing_")]
    return "WITH " + ",\n".join([star_fixture.view_ctes(*views), *steps])


def _lookback_steps(kind: str, cohort: str = "cohort", top: int = 10) -> str:
    """Long rows, the top categories and the common rows of one kind of event."""
    table, concept_col, date_col = EVENTS[kind]
    category = f"{kind}_category"
    return f"""
    {kind}_long AS (
        SELECT c.person_id, m.ancestor_concept_name AS {category}
        FROM {cohort} c
        LEFT JOIN {table} e ON e.person_id = c.person_id
          AND c.disease_start_date - e.{date_col} BETWEEN 0 AND 360
        LEFT JOIN {kind}_map m ON m.descendant_concept_id = e.{concept_col}),
    {kind}_top AS (
        SELECT {category}, count(*) AS category_count FROM {kind}_long GROUP BY {category}
        ORDER BY category_count DESC, {category} ASC NULLS LAST LIMIT {top}),
    {kind}_common AS (
        SELECT person_id, {category} FROM {kind}_long
        WHERE {category} IN (SELECT {category} FROM {kind}_top WHERE {category} IS NOT NULL)),
    {kind}_wide AS (
        SELECT person_id, {_cells(kind)} FROM {kind}_common GROUP BY person_id),
    {kind}_index AS (
        SELECT c.person_id, c.disease_start_date, {_cells(kind)}
        FROM (SELECT DISTINCT person_id, disease_start_date FROM {cohort}) c
        JOIN {table} e ON e.person_id = c.person_id
          AND c.disease_start_date - e.{date_col} BETWEEN 0 AND 360
        JOIN (SELECT descendant_concept_id, ancestor_concept_name AS {category}
              FROM {kind}_map JOIN {kind}_top ON ancestor_concept_name = {category}) m
          ON m.descendant_concept_id = e.{concept_col}
        GROUP BY c.person_id, c.disease_start_date)"""


def _cells(kind: str) -> str:
    columns = CONDITION_COLUMNS if kind == "condition" else DRUG_COLUMNS
    return ", ".join(
        f"CAST(sum(CASE WHEN {kind}_category = '{category}' THEN 1 END) AS BIGINT) AS {name}"
        for category, name in columns.items()
    )


def _features_sql(cohort: str, grain: str) -> str:
    suffix, keys = ("wide", matrix.PERSON_GRAIN) if grain == "person" else ("index", matrix.INDEX_GRAIN)
    numbers = [*CONDITION_COLUMNS.values(), *DRUG_COLUMNS.values(), *matrix.DEMOGRAPHICS]
    filled = ", ".join(f"coalesce({name}, 0) AS {name}" for name in numbers)
    shown = "" if grain == "person" else "person_id, disease_start_date, "
    using = ", ".join(keys)
    return f"""
    {_with("first_or_death")}, {_lookback_steps("condition", cohort)}, {_lookback_steps("drug", cohort)}
    SELECT {shown}CASE WHEN death_date IS NULL THEN 0 ELSE 1 END AS target, {filled}
    FROM {cohort}
    LEFT JOIN condition_{suffix} USING ({using})
    LEFT JOIN drug_{suffix} USING ({using})
    LEFT JOIN person USING (person_id)"""


def _stumps_sql() -> str:
    """Each round: sums by feature and value, the best cut, and what it adds to the margins."""
    unit, reg, eta = boosting.UNIT, STUMPS.reg_lambda, STUMPS.eta
    cells = ", ".join(f"{{'f': {i}, 'x': CAST({name} AS DOUBLE)}}" for i, name in enumerate(STUMP_FEATURES))
    gain = lambda g, h: f"({g} / {unit}.0::DOUBLE) * ({g} / {unit}.0::DOUBLE) / ({h} / {unit}.0::DOUBLE + {reg}::DOUBLE)"
    value = lambda g, h: f"-{eta}::DOUBLE * ({g} / {unit}.0::DOUBLE) / ({h} / {unit}.0::DOUBLE + {reg}::DOUBLE)"
    steps = []
    for number in range(1, STUMPS.rounds + 1):
        p = f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-margin{number - 1})))"
        steps.append(f"""
        g{number} AS (
            SELECT row_id, CAST(round(({p} - target) * {unit}) AS BIGINT) AS g,
                   CAST(round({p} * (1.0::DOUBLE - {p}) * {unit}) AS BIGINT) AS h FROM m{number - 1}),
        sums{number} AS (
            SELECT f, x, sum(g) AS g, sum(h) AS h FROM cells JOIN g{number} USING (row_id) GROUP BY f, x),
        sides{number} AS (
            SELECT f, x, CAST(sum(g) OVER (PARTITION BY f ORDER BY x) AS BIGINT) AS gl,
                   CAST(sum(h) OVER (PARTITION BY f ORDER BY x) AS BIGINT) AS hl,
                   CAST(sum(g) OVER (PARTITION BY f) AS BIGINT) AS g, CAST(sum(h) OVER (PARTITION BY f) AS BIGINT) AS h
            FROM sums{number}),
        gains{number} AS (
            SELECT *, {gain("gl", "hl")} + {gain("(g - gl)", "(h - hl)")} - {gain("g", "h")} AS gain FROM sides{number}
            WHERE hl >= {int(STUMPS.min_child_weight * unit)} AND h - hl >= {int(STUMPS.min_child_weight * unit)}),
        best{number} AS (
            SELECT * FROM gains{number} WHERE gain >= {STUMPS.gamma} ORDER BY gain DESC, f, x LIMIT 1),
        all{number} AS (SELECT CAST(sum(g) AS BIGINT) AS g, CAST(sum(h) AS BIGINT) AS h FROM g{number}),
        m{number} AS (
            SELECT m{number - 1}.*, margin{number - 1} + CASE
                       WHEN b.f IS NULL THEN {value("a.g", "a.h")}
                       WHEN c.x <= b.x THEN {value("b.gl", "b.hl")}
                       ELSE {value("(b.g - b.gl)", "(b.h - b.hl)")} END AS margin{number}
            FROM m{number - 1} CROSS JOIN all{number} a LEFT JOIN best{number} b ON TRUE
            LEFT JOIN cells c ON c.row_id = m{number - 1}.row_id AND c.f = b.f)""")
    return f"""
        WITH features AS ({_features_sql("cohort", "index")}),
        m0 AS (SELECT *, row_number() OVER () AS row_id, 0.0::DOUBLE AS margin0 FROM features),
        cells AS (SELECT row_id, cell.f AS f, cell.x AS x FROM (SELECT row_id, unnest([{cells}]) AS cell FROM m0)),
        {", ".join(steps)}
        SELECT person_id, disease_start_date, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-margin{STUMPS.rounds})), 9) AS risk
        FROM m{STUMPS.rounds}"""


def _contract_sql() -> str:
    """Every rule of the seven contracts, in words of its own for each kind of fault."""
    checks = []
    for table, view in CHECKED.items():
        for column, rule, broken in CONTRACT_RULES[table]:
            count = "CAST(1 AS BIGINT)" if rule == "missing_column" else f"count(*) FILTER (WHERE {broken})"
            checks.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
                f"{count} AS violations" + ("" if rule == "missing_column" else f" FROM {view}")
            )
    return f"WITH {star_fixture.view_ctes(*star_fixture.VIEWS)} " + " UNION ALL ".join(checks)


def _required(*columns: str) -> list[tuple[str, str, str]]:
    return [(column, "required", f"{column} IS NULL") for column in columns]


def _missing(*columns: str) -> list[tuple[str, str, str]]:
    return [(column, "missing_column", "") for column in columns]


def _not_a_date(*columns: str) -> list[tuple[str, str, str]]:
    return [
        (column, "date_format", f"{column} IS NOT NULL AND try_strptime({column}, '%Y%m%d') IS NULL")
        for column in columns
    ]


def _too_long(**lengths: int) -> list[tuple[str, str, str]]:
    return [(column, "max_length", f"length({column}) > {n}") for column, n in lengths.items()]


def _not_a_number(*columns: str) -> list[tuple[str, str, str]]:
    return [
        (column, "number_format", f"{column} IS NOT NULL AND TRY_CAST({column} AS BIGINT) IS NULL")
        for column in columns
    ]


CONTRACT_RULES: dict[str, list[tuple[str, str, str]]] = {
    "condition_occurrence": _required("person_id", "condition_concept_id", "condition_start_date")
    + _not_a_date("condition_start_date")
    + _missing("condition_occurrence_id", "condition_type_concept_id"),
    "drug_exposure": _required("person_id", "drug_concept_id", "drug_exposure_start_date")
    + _not_a_date("drug_exposure_start_date")
    + _missing("drug_exposure_id", "drug_exposure_end_date", "drug_type_concept_id"),
    "death": _required("person_id", "death_date") + _not_a_date("death_date"),
    "observation_period": _required(
        "person_id", "observation_period_start_date", "observation_period_end_date"
    )
    + _not_a_date("observation_period_start_date", "observation_period_end_date")
    + _missing("observation_period_id", "period_type_concept_id"),
    "person": _required("person_id", "gender_concept_id", "year_of_birth", "race_concept_id")
    + _not_a_number("person_id", "gender_concept_id", "year_of_birth", "race_concept_id")
    + _missing("ethnicity_concept_id"),
    "concept": _required(
        "concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code"
    )
    + _too_long(concept_name=255, domain_id=20, vocabulary_id=20, concept_class_id=20, concept_code=50)
    + _missing("valid_start_date", "valid_end_date"),
    "concept_ancestor": _required("ancestor_concept_id", "descendant_concept_id")
    + _missing("min_levels_of_separation", "max_levels_of_separation"),
}


def _landing_sql(view: str, *dates: str, numbers: str = "") -> str:
    cells = [f"CAST(try_strptime({c}, '%Y%m%d') AS DATE) AS {c}" for c in dates]
    shown = ", ".join([*filter(None, [numbers]), *cells])
    return f"WITH {star_fixture.view_ctes(view)} SELECT {shown} FROM {view}"


def _metrics_sql() -> str:
    """Confusion counts, the rank-sum area, and the precision-recall trapezoids."""
    formula = "(7919 * person_id + 31 * year(disease_start_date) + 17 * month(disease_start_date)) % 1511 / CAST(1510.0 AS DOUBLE)"
    return f"""
    {_with('cohort')},
    scored AS (
        SELECT CASE WHEN death_date IS NULL THEN 0 ELSE 1 END AS y, {formula} AS x FROM cohort),
    sizes AS (SELECT sum(y) AS p_all, sum(1 - y) AS n_all FROM scored),
    ranked AS (
        SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS place FROM scored),
    roc AS (
        SELECT (sum(CASE WHEN y = 1 THEN place END) - max(p_all) * (max(p_all) + 1) / 2.0)
               / (max(p_all) * max(n_all)) AS area FROM ranked, sizes),
    steps AS (
        SELECT x, sum(y) AS p, sum(sum(y)) OVER w AS tp, sum(count(*)) OVER w AS seen
        FROM scored GROUP BY x WINDOW w AS (ORDER BY x DESC)),
    points AS (
        SELECT p, tp / seen AS precision_here,
               coalesce(lag(tp / seen) OVER (ORDER BY x DESC), tp / seen) AS precision_before FROM steps),
    pr AS (SELECT sum(p * (precision_here + precision_before) / 2) / max(p_all) AS area FROM points, sizes)
    SELECT name, round(CAST(value AS DOUBLE), 9) AS value FROM (
        SELECT 'true_positive' AS name, count(*) FILTER (WHERE y = 1 AND x > 0.5) AS value FROM scored
        UNION ALL SELECT 'false_positive', count(*) FILTER (WHERE y = 0 AND x > 0.5) FROM scored
        UNION ALL SELECT 'false_negative', count(*) FILTER (WHERE y = 1 AND x <= 0.5) FROM scored
        UNION ALL SELECT 'true_negative', count(*) FILTER (WHERE y = 0 AND x <= 0.5) FROM scored
        UNION ALL SELECT 'areaUnderROC', area FROM roc
        UNION ALL SELECT 'areaUnderPR', area FROM pr)"""


def oracle_sql() -> dict[str, str]:
    landing = f"""
    WITH {star_fixture.view_ctes("landing_condition")}
    SELECT person_id, condition_concept_id,
           CAST(try_strptime(condition_start_date, '%Y%m%d') AS DATE) AS condition_start_date
    FROM landing_condition"""
    steps = {
        kind: f"{_with('cohort')}, {_lookback_steps(kind)}" for kind in ("condition", "drug")
    }
    features_person_sql = _features_sql("cohort", "person")
    cohort_sql = f"{_with('cohort')} SELECT * FROM cohort"
    oracles = {
        "landing_dates": landing,
        "patient_csv": landing,
        "drug_csv": _landing_sql(
            "landing_drug", "drug_exposure_start_date", numbers="person_id, drug_concept_id"
        ),
        "death_csv": _landing_sql("landing_death", "death_date", numbers="person_id"),
        "period_csv": _landing_sql(
            "landing_period", "observation_period_start_date", "observation_period_end_date", numbers="person_id"
        ),
        "person_csv": _landing_sql(
            "landing_person",
            numbers="CAST(person_id AS BIGINT) AS person_id, CAST(gender_concept_id AS INT) AS gender_concept_id,"
            " TRY_CAST(year_of_birth AS INT) AS year_of_birth, CAST(race_concept_id AS INT) AS race_concept_id",
        ),
        "metrics_of_scores": _metrics_sql(),
        "score_rows": f"""{_with('cohort')}
            SELECT person_id, disease_start_date, TRUE AS is_probability FROM cohort""",
        "vocabulary_csv": f"WITH {star_fixture.view_ctes('concept')} SELECT * FROM concept",
        "landing_rejects": f"""
            WITH {star_fixture.view_ctes("landing_condition")},
            lines AS (
                SELECT *, try_strptime(condition_start_date, '%Y%m%d') AS day, person_id % 11 AS planted,
                       coalesce(CAST(person_id AS VARCHAR), '') || ',' || coalesce(CAST(condition_concept_id AS VARCHAR), '') AS cut
                FROM landing_condition),
            judged AS (
                SELECT *, cut || ',' || coalesce(condition_start_date, '') AS whole,
                       CASE WHEN planted IN (3, 7) THEN 'fields'
                            WHEN condition_start_date IS NOT NULL AND day IS NULL
                            THEN 'condition_start_date: date_format' END AS reasons
                FROM lines)
            SELECT CASE WHEN reasons IS NULL THEN person_id END AS person_id,
                   CASE WHEN reasons IS NULL THEN condition_concept_id END AS condition_concept_id,
                   CASE WHEN reasons IS NULL THEN CAST(day AS DATE) END AS condition_start_date,
                   CASE WHEN reasons IS NULL THEN NULL WHEN planted = 3 THEN cut
                        WHEN planted = 7 THEN whole || ',more' ELSE whole END AS record, reasons
            FROM judged""",
        "contract_check": _contract_sql(),
        "query_view": f"""{_with('members')}
            SELECT condition_start_date, count(*) AS occurrences
            FROM members GROUP BY condition_start_date""",
        "condition_category_map": f"{_with('condition_map')} SELECT * FROM condition_map",
        "drug_category_map": f"{_with('drug_map')} SELECT * FROM drug_map",
        "cohort_members": f"{_with('members')} SELECT * FROM members",
        "cohort": cohort_sql,
        "cohort_by_id": cohort_sql,
        "cohort_as_written": f"{_with('cohort_as_written')} SELECT * FROM cohort_as_written",
        "cohort_targets": f"""{_with('cohort_as_written')}
            SELECT person_id, disease_concept_id, disease_start_date,
                   min(death_date) AS first_death_date, count(*) AS row_count
            FROM cohort_as_written GROUP BY person_id, disease_concept_id, disease_start_date""",
        "cohort_or_death": f"{_with('cohort_or_death')} SELECT * FROM cohort_or_death",
        "cohort_first_onset": f"{_with('cohort_first_onset')} SELECT * FROM cohort_first_onset",
        "top_conditions": f"{steps['condition']} SELECT * FROM condition_top",
        "top_drugs": f"{steps['drug']} SELECT * FROM drug_top",
        "top_named_conditions": f"""{steps['condition']}
            SELECT condition_category, count(*) AS category_count FROM condition_long
            WHERE condition_category IS NOT NULL GROUP BY condition_category
            ORDER BY category_count DESC, condition_category LIMIT 10""",
        "features_person": features_person_sql,
        "features_index": _features_sql("cohort", "index"),
        "features_first_onset": _features_sql("first_or_death", "index"),
        "features_as_written": _features_sql("cohort_as_written", "index"),
        "dataset_roundtrip": features_person_sql,
        "replaced_dataset": features_person_sql,
        "boosted_scores": _stumps_sql(),
        "split_assignment": f"""{_with('cohort')}
            SELECT person_id, disease_start_date,
                   CASE WHEN death_date IS NULL THEN 0 ELSE 1 END AS target,
                   CASE WHEN CAST('0x' || substr(md5(CAST(person_id AS VARCHAR)), 1, 8) AS BIGINT)
                             % 10000 < 9000 THEN 'train' ELSE 'test' END AS part
            FROM cohort""",
    }
    for kind in ("condition", "drug"):
        oracles[f"{kind}_lookback"] = f"{steps[kind]} SELECT * FROM {kind}_long"
        oracles[f"common_{kind}s"] = f"{steps[kind]} SELECT * FROM {kind}_common"
        oracles[f"{kind}_counts"] = f"""{steps[kind]}
            SELECT person_id, {kind}_category, count(*) AS category_count
            FROM {kind}_common GROUP BY person_id, {kind}_category"""
        oracles[f"{kind}_pivot"] = f"{steps[kind]} SELECT * FROM {kind}_wide"
    return oracles | _text_queries()[1]
