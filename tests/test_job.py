"""The whole job on the small test data."""

from __future__ import annotations

import pytest

from __spark_entry__ import DISEASE
from onsetlab.operators.model import train
from onsetlab.plans import mortality
from onsetlab.sources import sinks, staging

OPTIONS = mortality.MortalityOptions(disease_codes=DISEASE, stage_conditions=True)


@pytest.fixture(scope="module")
def finished(spark, clinic, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("output"))
    return mortality.run(spark, clinic.tables(), output, OPTIONS, "job_train", "job_test")


def test_datasets_lead_with_the_target_and_hold_no_keys(spark, finished):
    training = sinks.read_dataset(spark, finished.train_path)
    test = sinks.read_dataset(spark, finished.test_path)
    assert training.columns == test.columns
    assert training.columns[0] == "target"
    assert training.columns[-3:] == ["gender_concept_id", "year_of_birth", "race_concept_id"]
    assert not {"person_id", "disease_start_date"} & set(training.columns)
    assert training.count() + test.count() == 145
    assert spark.table("job_train").count() == training.count()
    assert spark.table("job_test").count() == test.count()


def test_columns_follow_the_top_categories(finished):
    conditions, drugs = finished.options.condition_columns, finished.options.drug_columns
    assert len(conditions) == 9 and len(drugs) == 8
    assert all(name.startswith("cond_") for name in conditions.values())
    assert all(name.startswith("drug_") for name in drugs.values())


def test_scores_of_new_patients(spark, clinic, finished):
    tables = clinic.tables()
    with staging.Stages(spark) as stages:
        options = mortality.replace(finished.options, min_followup=-1)
        scores = mortality.score_patients(finished.model, tables, options, stages).collect()
    assert len(scores) > 145
    assert set(scores[0].asDict()) == {"person_id", "disease_start_date", "risk"}
    assert all(0 <= row.risk <= 1 for row in scores)


def test_model_learns_a_planted_signal(spark):
    rows = [(int(i % 7 == 0), i % 7, i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "target int, signal int, noise int")
    model = train(df)
    from onsetlab.operators.model import evaluate

    values = {(r.metric, r.name): r.value for r in evaluate(model, df).collect()}
    assert values["area", "areaUnderROC"] == pytest.approx(1.0)
    assert values["confusion", "true_positive"] == sum(row[0] for row in rows)
    assert values["importance", "signal"] > 0.9


def test_jobs_need_two_weights(spark, clinic, tmp_path):
    with pytest.raises(ValueError):
        mortality.run(spark, clinic.tables(), str(tmp_path), mortality.replace(OPTIONS, weights=(1,)))


def test_missing_features_lose_no_row(spark):
    from onsetlab.operators.model import score

    rows = [(int(i % 7 == 0), i % 7 if i % 3 else None, i) for i in range(600)]
    df = spark.createDataFrame(rows, "target int, signal int, person_id long")
    assert score(train(df), df).filter("risk IS NOT NULL").count() == 600


def test_areas_are_exact_beyond_a_thousand_scores(spark):
    import random

    from onsetlab.operators.model import score_metrics

    source = random.Random(5)
    rows = [(source.random() ** 2, source.random()) for _ in range(5000)]
    rows = [(x, int(u < x)) for x, u in rows] + [(0.5, 1), (0.5, 0), (None, 1), (0.1, None)]
    df = spark.createDataFrame(rows, "risk double, target int")
    values = {r.name: r.value for r in score_metrics(df).collect()}
    known = [(x, y) for x, y in rows if x is not None and y is not None]
    good = sorted(x for x, y in known if y)
    wins = sum((x > z) + (x == z) / 2 for x in good for z in (z for z, y in known if not y))
    assert values["areaUnderROC"] == pytest.approx(wins / (len(good) * (len(known) - len(good))), abs=1e-12)
    assert values["true_positive"] == sum(1 for x, y in known if y and x > 0.5)


def test_clustered_scores_use_many_ranges(spark, monkeypatch):
    import random

    from onsetlab.operators import model

    source = random.Random(6)
    # All scores but one within 1e-9 of each other, and some that are no numbers.
    close = [(0.3 + i * 2.5e-13, int(source.random() < 0.4)) for i in range(4000)]
    rows = [*close, *close[:500], (0.9, 1), (float("inf"), 0), (float("-inf"), 1), (float("nan"), 1), (float("nan"), 0)]
    df = spark.createDataFrame(rows, "risk double, target int")
    values = {r.name: r.value for r in model.score_metrics(df).collect()}
    order = lambda x: (x != x, x if x == x else 0)  # noqa: E731  not-a-number is the largest
    steps = {}
    for x, y in rows:
        p, n = steps.get(order(x), (0, 0))
        steps[order(x)] = (p + y, n + 1 - y)
    tp = fp = roc = pr = 0
    p_all, n_all = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    for at in sorted(steps, reverse=True):
        p, n = steps[at]
        here = (tp + p) / (tp + fp + p + n)
        pr += p * (here + (tp / (tp + fp) if tp + fp else here)) / 2
        roc += n * (tp + p / 2)
        tp, fp = tp + p, fp + n
    assert values["areaUnderROC"] == pytest.approx(roc / (p_all * n_all), abs=1e-12)
    assert values["areaUnderPR"] == pytest.approx(pr / p_all, abs=1e-12)

    counts = df.groupBy(df.risk.alias("x")).agg({"target": "sum"}).withColumnRenamed("sum(target)", "p").selectExpr("x", "p", "p AS n")
    sizes = model.ranged(counts).groupBy("part").count().collect()
    assert len(sizes) > 200 and max(r["count"] for r in sizes) < 100


@pytest.mark.parametrize("rows", [[], [(0.5, 1), (0.7, 1)], [(0.5, 0)]])
def test_areas_of_an_empty_or_one_class_part_are_null(spark, rows):
    from onsetlab.operators.model import score_metrics

    values = {r.name: r.value for r in score_metrics(spark.createDataFrame(rows, "risk double, target int")).collect()}
    assert values["areaUnderROC"] is None and values["areaUnderPR"] is None
    assert sum(v for name, v in values.items() if not name.startswith("area")) == len(rows)


def test_a_top_category_without_a_column_is_an_error(spark, clinic):
    options = mortality.replace(OPTIONS, condition_columns={"Brand#1": "cond_brand_1"})
    with staging.Stages(spark) as stages, pytest.raises(ValueError, match="without a column"):
        mortality.build_matrix(clinic.tables(), options, stages)


def test_a_part_of_no_bucket_is_an_error():
    from onsetlab.operators.split import split_number

    with pytest.raises(ValueError, match="weight"):
        split_number([1.0, 0.00001])
