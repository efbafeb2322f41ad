from __future__ import annotations

from collections import Counter

import pytest
from brute import day, lookback_rows, random_history

from onsetlab.operators import lookback as lb

COHORT = "person_id long, disease_concept_id long, disease_start_date date, death_date date"
EVENTS = "person_id long, drug_concept_id long, drug_exposure_start_date date"
MAP = (
    "ancestor_concept_id long, ancestor_concept_name string, "
    "ancestor_concept_code string, descendant_concept_id long"
)
# Concept 1 has two ancestors, 2 has two of the same name, 4 has none.
CATEGORIES = [(1, "A"), (1, "B"), (2, "B"), (2, "B"), (3, "C")]


def frames(spark, index, events, categories=CATEGORIES):
    cohort = spark.createDataFrame([(p, 1, d, None) for p, d in index], COHORT)
    named = [(10, name, name, concept) for concept, name in categories]
    return cohort, spark.createDataFrame(events, EVENTS), spark.createDataFrame(named, MAP)


def long_rows(cohort, events, categories, **options):
    return lb.lookback_categories(
        cohort, events, "drug_concept_id", "drug_exposure_start_date", categories, "category", **options
    )


def rows(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("lookback", [(0, 360), (1, 30), (0, 0), (-20, 45), (100, 900)])
def test_lookback_equals_brute_force(spark, lookback):
    members, _, _, events = random_history(sum(lookback))
    index = [(person, onset) for person, _, onset in members]
    expected = lookback_rows(index, events, CATEGORIES, lookback)
    assert rows(long_rows(*frames(spark, index, events), lookback=lookback)) == expected


def test_lookback_without_broadcast(spark):
    members, _, _, events = random_history(8)
    index = [(person, onset) for person, _, onset in members]
    expected = lookback_rows(index, events, CATEGORIES)
    assert rows(long_rows(*frames(spark, index, events), max_bytes=-1)) == expected


def test_window_edges_at_any_calendar_day(spark):
    edges = {-1: False, 0: True, 360: True, 361: False}
    onsets = [-10_000, -1, 0, 1, 360, 361, 722, 5000]
    cases = [(onset, ago) for onset in onsets for ago in edges]
    index = [(person, day(onset)) for person, (onset, _) in enumerate(cases)]
    events = [(person, 3, day(onset - ago)) for person, (onset, ago) in enumerate(cases)]
    expected = {(person, "C" if edges[ago] else None): 1 for person, (_, ago) in enumerate(cases)}
    assert rows(long_rows(*frames(spark, index, events))) == expected


def test_cohort_rows_without_events_keep_a_row(spark):
    index = [(1, day(0)), (1, day(0)), (2, day(0)), (None, day(0)), (3, None)]
    tables = frames(spark, index, [(2, 4, day(0)), (None, 1, day(0)), (3, 1, None)])
    assert rows(long_rows(*tables)) == {(1, None): 2, (2, None): 1, (None, None): 1, (3, None): 1}


def test_one_event_meets_several_onsets(spark):
    index = [(1, day(0)), (1, day(10)), (1, day(361))]
    tables = frames(spark, index, [(1, 1, day(0))] * 2)
    assert rows(long_rows(*tables)) == {(1, "A"): 4, (1, "B"): 4, (1, None): 1}


def test_literal_and_counted_cohorts_agree(spark):
    cohort, events, categories = frames(spark, [(1, day(0))] * 5 + [(1, day(3))], [(1, 1, day(0))])
    counted = cohort.groupBy(*cohort.columns).count().withColumnRenamed("count", "row_count")
    assert rows(long_rows(cohort, events, categories)) == rows(long_rows(counted, events, categories))


def test_bounds_are_checked(spark):
    tables = frames(spark, [(1, day(0))], [(1, 1, day(0))])
    with pytest.raises(ValueError):
        long_rows(*tables, lookback=(5, 4))


COUNTS = [
    (1, "A", 5), (2, "A", 1), (1, "B", 4), (2, "C", 4), (3, None, 4), (1, "D", 1), (3, "E", 4),
]


@pytest.fixture()
def counts(spark):
    return spark.createDataFrame(COUNTS, "person_id long, category string, category_count long")


@pytest.mark.parametrize(
    "n, null_takes_slot, names",
    [
        (1, True, ["A"]),
        (3, True, ["A", "B", "C"]),
        (5, True, ["A", "B", "C", "E", None]),
        (6, True, ["A", "B", "C", "E", None, "D"]),
        (5, False, ["A", "B", "C", "E", "D"]),
    ],
)
def test_ties_at_the_cut(counts, n, null_takes_slot, names):
    top = lb.top_categories(counts, "category", n, null_takes_slot)
    assert [row.category for row in top.collect()] == names
    named = sorted(name for name in names if name)
    assert lb.top_category_names(counts, "category", n, null_takes_slot) == named


def test_restriction_drops_rows_without_category(counts):
    kept = lb.restrict_to_top(counts, "category", 5)
    assert rows(kept) == Counter(
        row for row in map(tuple, COUNTS) if row[1] in ("A", "B", "C", "E")
    )


def test_common_rows_from_long_rows(spark):
    pairs = [(1, "A")] * 3 + [(2, "A"), (2, "B"), (3, None), (3, None)]
    long = spark.createDataFrame(pairs, "person_id long, category string")
    assert rows(lb.common_categories(long, "category", 2)) == {(1, "A"): 3, (2, "A"): 1}
    both = lb.common_categories(long, "category", 2, null_takes_slot=False)
    assert rows(both) == {(1, "A"): 3, (2, "A"): 1, (2, "B"): 1}


def final_plan(df) -> list[str]:
    """The lines of the plan that ran, after its rows were collected."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].splitlines()


@pytest.mark.parametrize("max_bytes", [1 << 20, -1])
def test_events_are_read_once_and_filtered_before_they_are_counted(spark, tmp_path, max_bytes):
    path = str(tmp_path / "events")
    cohort = spark.createDataFrame([(1, 5, day(400), None), (3, 5, day(0), None)], COHORT)
    spark.createDataFrame([(1, 7, day(390)), (2, 7, day(390)), (1, 7, day(390))], EVENTS).write.parquet(path)
    met = lb.lookback_events(cohort, spark.read.parquet(path), "drug_concept_id", "drug_exposure_start_date", max_bytes=max_bytes)
    assert rows(met) == {(1, 7, day(390), 2, 1): 1, (3, None, None, 1, 1): 1}
    plan = final_plan(met)
    scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line]
    # Both the events met and the onsets without any come from one shuffle.
    assert len(scans) == 1
    exchange = next(line for line in reversed(plan[: scans[0]]) if "Exchange" in line and "Reused" not in line)
    assert "hashpartitioning" in exchange and "bucket" in exchange
    above = plan[: scans[0]]
    assert any("Join" in line for line in above)


def test_a_person_with_most_events_is_divided_by_time(spark, tmp_path):
    path = str(tmp_path / "hot")
    events = [(1, concept, day(when)) for when in range(0, 4000, 2) for concept in (1, 2)]
    spark.createDataFrame(events, EVENTS).write.parquet(path)
    index = [(1, day(onset)) for onset in range(0, 4000, 97)]
    cohort = spark.createDataFrame([(p, 1, d, None) for p, d in index], COHORT)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        met = lb.lookback_events(cohort, spark.read.parquet(path), "drug_concept_id", "drug_exposure_start_date", max_bytes=-1)
        sizes = met.rdd.mapPartitions(lambda part: [sum(r["event_rows"] for r in part)]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) >= 0.9 * len(events)
    assert sum(size > 0 for size in sizes) >= 8 and max(sizes) < sum(sizes) / 3
