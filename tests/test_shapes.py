"""Sweep, lookup, row expansion, matrix and split on small frames."""

from __future__ import annotations

from collections import Counter
from random import Random

import pytest
from brute import day

from onsetlab.functions.naming import feature_names
from onsetlab.operators import lookback as lb
from onsetlab.operators import matrix, rows, split
from onsetlab.operators.lookup import fits_broadcast, lookup_join, prefilter_keys
from onsetlab.operators.sweep import covering_weight
from onsetlab.sources import staging


def plain(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def test_covering_weight_equals_brute_force(spark):
    random = Random(5)

    def days(count):
        return [(random.choice([0, 0, 1, 2, 3]), random.randrange(-50, 50)) for _ in range(count)]

    points = [(key, day(d), i) for i, (key, d) in enumerate(days(200))]
    intervals = [
        (key, day(lo), day(lo + random.randrange(-3, 20)), random.randrange(1, 4), random.randrange(2))
        for key, lo in days(300)
    ]
    covered = covering_weight(
        spark.createDataFrame(points, "key long, at date, tag long"),
        spark.createDataFrame(intervals, "key long, lo date, hi date, a int, b int"),
        "key", "at", "lo", "hi", ["a", "b"],
    )
    assert covered.columns == ["key", "at", "tag", "a", "b"]
    assert plain(covered) == Counter(
        (key, at, tag, *(
            sum(interval[w] for interval in intervals if interval[0] == key and interval[1] <= at <= interval[2])
            for w in (3, 4)
        ))
        for key, at, tag in points
    )


def test_covering_weight_plan_has_no_join(spark):
    points = spark.createDataFrame([(1, day(0))], "key long, at date")
    intervals = spark.createDataFrame([(1, day(0), day(1), 1)], "key long, lo date, hi date, w int")
    covered = covering_weight(points, intervals, "key", "at", "lo", "hi", ["w"])
    assert "Join" not in covered._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_is_the_same_at_any_size(spark, how):
    facts = spark.createDataFrame(
        [(i, 7 if i % 3 else i % 50) for i in range(900)] + [(900, None)], "id long, key long"
    )
    table = spark.createDataFrame([(k, f"name {k}") for k in range(0, 50, 2)] + [(7, "a"), (7, "b")], "key long, name string")
    broadcast = lookup_join(facts, table, "key", how, ["id"])
    salted = lookup_join(facts, table, "key", how, ["id"], max_bytes=-1)
    assert plain(salted) == plain(broadcast) == plain(facts.join(table, "key", how))
    assert "_salt" not in salted.columns


def test_lookup_join_computes_the_large_side_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    facts = spark.range(0, 4000, 1, 4).selectExpr("id", "IF(id % 3 = 0, 7, id % 1000) AS key").mapInArrow(count, "id long, key long")
    table = spark.range(1000).selectExpr("id AS key", "id * 2 AS twice")
    joined = lookup_join(facts, table, "key", "inner", ["id"], max_bytes=-1)
    sizes = joined.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert (sum(sizes), seen.value) == (4000, 4000)


def test_lookup_join_divides_hot_keys_only(spark):
    facts = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 7, id) AS key")
    table = spark.range(3000).selectExpr("id AS key")
    joined = lookup_join(facts, table, "key", "inner", ["id"], max_bytes=-1)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "7" in plan and joined.count() == 3000


def test_matrix_is_not_shuffled_for_small_counts(spark):
    with staging.Stages(spark) as stages:
        small = small_matrix(spark, "person", stages=stages)
        assert plain(small) == plain(small_matrix(spark, "person"))
        shuffles = [m._jdf.queryExecution().optimizedPlan().toString().count("_chunk") for m in (small, small_matrix(spark, "person"))]
    assert shuffles[0] == 0 < shuffles[1]


@pytest.mark.parametrize("options", [{"most": 100}, {"shuffled": True}])
def test_expand_rows_where_they_are(spark, options):
    counts = [0, 1, 2, 99, 100]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "id long, n long")
    assert plain(rows.expand_rows(df, "n", **options)) == Counter({(i,): n for i, n in enumerate(counts) if n})
    large = spark.createDataFrame([(1, rows.CHUNK + 5), (2, 3)], "id long, n long")
    assert rows.expand_rows(large, "n", shuffled=True).groupBy("id").count().collect()


def test_lookup_join_rejects_other_joins(spark):
    facts = spark.range(3).withColumnRenamed("id", "key")
    with pytest.raises(ValueError):
        lookup_join(facts, facts, "key", "full", ["key"])


def test_broadcast_is_decided_by_measured_bytes(spark):
    table = spark.createDataFrame([("x" * 1000,), (None,)], "text string")
    assert fits_broadcast(table, 1100)
    assert not fits_broadcast(table, 1000)
    assert fits_broadcast(spark.createDataFrame([], "text string"), 0)


def test_prefilter_only_drops_unknown_keys(spark):
    facts = spark.range(10).withColumnRenamed("id", "key")
    keys = spark.range(4).withColumnRenamed("id", "key")
    assert prefilter_keys(facts, keys, "key").count() == 4
    assert prefilter_keys(facts, keys, "key", max_bytes=-1).count() == 10


def test_expand_rows_of_any_count(spark, monkeypatch):
    monkeypatch.setattr(rows, "CHUNK", 100)
    counts = [0, 1, 2, 99, 100, 101, 250, 1000]
    df = spark.createDataFrame([(i, None, n) for i, n in enumerate(counts)], "id long, x string, n long")
    expanded = rows.expand_rows(df, "n")
    assert plain(expanded) == Counter({(i, None): n for i, n in enumerate(counts) if n})


def test_expand_rows_spreads_the_copies_of_one_row(spark):
    expanded = rows.expand_rows(spark.createDataFrame([(1, 40 * rows.CHUNK)], "id long, n long"), "n")
    sizes = expanded.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 40 * rows.CHUNK
    assert max(sizes) < sum(sizes)


def test_feature_names_do_not_clash():
    names = feature_names("cond_", ["Heart, lung", "heart lung", "HEART-LUNG", "Ärzte"])
    assert sorted(names.values()) == ["cond_heart_lung", "cond_heart_lung_2", "cond_heart_lung_3", "cond_rzte"]
    assert names == feature_names("cond_", sorted(names, reverse=True))


PAIRS = [(1, "A", 3), (1, "B", 1), (2, "A", 2), (3, "C", 9), (4, None, 2)]


def test_pivot_row_sums_equal_the_long_counts(spark):
    counts = spark.createDataFrame(PAIRS, "person_id long, category string, category_count long")
    wide = matrix.pivot_counts(counts, "category", {"A": "cond_a", "B": "cond_b"})
    assert plain(wide) == {(1, 3, 1): 1, (2, 2, None): 1}


def small_matrix(spark, grain, **options):
    cohort = spark.createDataFrame(
        [(1, 5, day(0), day(9)), (1, 5, day(0), day(9)), (1, 6, day(0), None), (2, 5, day(400), None), (9, 5, day(1), None)],
        "person_id long, disease_concept_id long, disease_start_date date, death_date date",
    )
    events = spark.createDataFrame(
        [(1, 1, day(0)), (1, 1, day(-360)), (1, 2, day(-361)), (2, 1, day(100)), (2, 2, day(400))],
        "person_id long, concept_id long, start date",
    )
    categories = spark.createDataFrame(
        [(1, "A", "A", 1), (2, "B", "B", 2)],
        "ancestor_concept_id long, ancestor_concept_name string, ancestor_concept_code string, descendant_concept_id long",
    )
    person = spark.createDataFrame(
        [(1, 8507, 1950, 1), (2, None, 1960, 2)],
        "person_id long, gender_concept_id int, year_of_birth int, race_concept_id int",
    )
    met = lb.lookback_events(cohort, events, "concept_id", "start")
    categorised = lb.categorise(met, categories, "category")
    wide = []
    for prefix in ("cond_", "drug_"):
        columns = feature_names(prefix, ["A", "B"])
        if grain == "index":
            wide.append(matrix.pivot_index_counts(cohort, categorised, "category", columns))
        else:
            wide.append(matrix.pivot_counts(lb.count_categories(categorised, "category"), "category", columns))
    return matrix.assemble_features(cohort, *wide, person, grain=grain, **options)


COLUMNS = ["target", "cond_a", "cond_b", "drug_a", "drug_b", "gender_concept_id", "year_of_birth", "race_concept_id"]


def test_person_grain_multiplies_repeated_rows(spark):
    features = small_matrix(spark, "person")
    assert features.columns == COLUMNS
    # Person 9 is not in the person table and has no events.
    assert plain(features) == {
        (1, 6, 0, 6, 0, 8507, 1950, 1): 2,
        (0, 6, 0, 6, 0, 8507, 1950, 1): 1,
        (0, 1, 1, 1, 1, 0, 1960, 2): 1,
        (0, 0, 0, 0, 0, 0, 0, 0): 1,
    }


def test_index_grain_counts_events_once(spark):
    features = small_matrix(spark, "index", keep_id=True)
    assert features.columns == ["person_id", "disease_start_date", *COLUMNS]
    assert plain(features.drop("person_id")) == {
        (day(0), 1, 2, 0, 2, 0, 8507, 1950, 1): 2,
        (day(0), 0, 2, 0, 2, 0, 8507, 1950, 1): 1,
        (day(400), 0, 1, 1, 1, 1, 0, 1960, 2): 1,
        (day(1), 0, 0, 0, 0, 0, 0, 0, 0): 1,
    }


def test_fill_can_leave_demographics_missing(spark):
    features = small_matrix(spark, "person", fill_cols=["cond_a", "cond_b"])
    missing = [row for row in features.collect() if row.cond_a == 0]
    assert [(row.drug_a, row.year_of_birth) for row in missing] == [(None, None)]


def test_fill_may_leave_everything_and_never_touches_keys(spark):
    features = small_matrix(spark, "person", fill_cols=[])
    assert any(row.cond_a is None for row in features.collect())
    cohort = spark.createDataFrame(
        [(None, 1, day(0), None)],
        "person_id long, disease_concept_id long, disease_start_date date, death_date date",
    )
    none = spark.createDataFrame([], "person_id long, cond_a long")
    person = spark.createDataFrame(
        [], "person_id long, gender_concept_id int, year_of_birth int, race_concept_id int"
    )
    drugs = none.withColumnRenamed("cond_a", "drug_a")
    matrix_rows = matrix.assemble_features(cohort, none, drugs, person, keep_id=True)
    assert plain(matrix_rows) == {(None, 0, 0, 0, 0, 0, 0): 1}


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        small_matrix(spark, "visit")


def test_split_depends_on_the_key_only(spark):
    keys = spark.range(5000).selectExpr("id % 1000 AS person_id", "id AS row")
    training, test = split.split(keys)
    in_test = {row.person_id for row in test.collect()}
    assert in_test.isdisjoint(row.person_id for row in training.collect())
    assert training.count() + test.count() == 5000
    assert 60 <= len(in_test) <= 140
    _, again = split.split(keys.repartition(7))
    assert plain(again) == plain(test)


def test_split_into_three_keeps_missing_keys(spark):
    keys = spark.createDataFrame([(i,) for i in range(300)] + [(None,)], "person_id long")
    parts = split.split(keys, (2, 1, 1))
    assert sum(part.count() for part in parts) == 301
    assert all(part.count() > 40 for part in parts)
    with pytest.raises(ValueError):
        split.split(keys, (1, 0))


def test_random_split_keeps_all_rows(spark):
    training, test = split.random_split(spark.range(1000))
    assert training.count() + test.count() == 1000
    assert 50 <= test.count() <= 150
