from __future__ import annotations

from collections import Counter

import pytest
from brute import cohort_rows, day, random_history

from onsetlab.operators.cohort import cohort_members, count_cohort, select_cohort

CONDITIONS = "person_id long, condition_concept_id long, condition_start_date date"
PERIODS = "person_id long, observation_period_start_date date, observation_period_end_date date"
DEATHS = "person_id long, death_date date"
MAP = (
    "ancestor_concept_id long, ancestor_concept_name string, "
    "ancestor_concept_code string, descendant_concept_id long"
)


def frames(spark, members, periods, deaths, concepts=(1, 2, 3)):
    categories = [(100, "Disease", "D1", concept) for concept in concepts]
    categories += [(101, "Wider", "D2", concept) for concept in concepts] + [(102, "Other", "D3", 9)]
    return (
        spark.createDataFrame(members, CONDITIONS),
        spark.createDataFrame(periods, PERIODS),
        spark.createDataFrame(deaths, DEATHS),
        spark.createDataFrame(categories, MAP),
    )


def rows(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize(
    "options", [{}, {"label": "as_written"}, {"followup": "or_death"}], ids=str
)
@pytest.mark.parametrize("seed", [1, 2])
def test_cohort_equals_brute_force(spark, seed, options):
    members, periods, deaths, _ = random_history(seed)
    cohort = select_cohort(
        *frames(spark, members, periods, deaths), disease_codes=["D1", "D2"], **options
    )
    expected = cohort_rows(
        members,
        periods,
        deaths,
        options.get("label", "within"),
        options.get("followup") == "or_death",
    )
    assert rows(cohort) == expected
    assert expected


def test_cohort_without_broadcast(spark):
    members, periods, deaths, _ = random_history(3)
    tables = frames(spark, members, periods, deaths)
    plain = select_cohort(*tables, disease_codes=["D1"])
    salted = select_cohort(*tables, disease_codes=["D1"], max_bytes=-1)
    assert rows(salted) == rows(plain)


def test_observation_must_exceed_the_days(spark):
    cases = [(360, 361, False), (361, 360, False), (361, 361, True), (2000, 2000, True)]
    members = [(person, 1, day(0)) for person in range(len(cases))]
    periods = [(p, day(-before), day(after)) for p, (before, after, _) in enumerate(cases)]
    cohort = select_cohort(*frames(spark, members, periods, []), disease_codes=["D1"])
    admitted = {person for person, case in enumerate(cases) if case[2]}
    assert {row.person_id for row in cohort.collect()} == admitted


def test_label_windows(spark):
    # Days from onset to death, and whether each label attaches it.
    cases = [
        (-361, False, True),
        (-360, False, False),
        (-1, False, False),
        (0, True, False),
        (360, True, False),
        (361, False, False),
    ]
    members = [(person, 1, day(0)) for person in range(len(cases))]
    periods = [(person, day(-900), day(900)) for person in range(len(cases))]
    deaths = [(person, day(died)) for person, (died, _, _) in enumerate(cases)]
    tables = frames(spark, members, periods, deaths)
    for column, label in ((1, "within"), (2, "as_written")):
        cohort = select_cohort(*tables, disease_codes=["D1"], label=label).collect()
        assert len(cohort) == len(cases)
        attached = {row.person_id for row in cohort if row.death_date is not None}
        assert attached == {person for person, case in enumerate(cases) if case[column]}


def test_two_periods_give_two_rows(spark):
    periods = [(1, day(-400), day(400)), (1, day(-800), day(800)), (1, day(-10), day(800))]
    tables = frames(spark, [(1, 1, day(0))], periods, [])
    assert rows(select_cohort(*tables, disease_codes=["D1"])) == {(1, 1, day(0), None): 2}


def test_short_period_admits_nothing(spark):
    # Its first admissible day lies after its last one.
    tables = frames(spark, [(1, 1, day(0))], [(1, day(-100), day(100)), (1, day(-361), day(361))], [])
    assert rows(select_cohort(*tables, disease_codes=["D1"])) == {(1, 1, day(0), None): 1}


def test_first_onset_is_one_row_per_person(spark):
    members = [(1, 2, day(5)), (1, 1, day(5)), (1, 1, day(900)), (2, 1, day(-390)), (2, 1, day(0))]
    periods = [(p, day(-400), day(2000)) for p in (1, 1, 2)]
    tables = frames(spark, members, periods, [(1, day(50)), (1, day(40))])
    cohort = select_cohort(*tables, disease_codes=["D1"], onset="first")
    # Person 2 was ill before being observed long enough.
    assert rows(cohort) == {(1, 1, day(5), day(40)): 1}


def test_or_death_admits_short_followup(spark):
    members = [(1, 1, day(0)), (2, 1, day(0)), (3, 1, day(0))]
    periods = [(1, day(-400), day(30)), (2, day(-400), day(30)), (3, day(-400), day(-5))]
    tables = frames(spark, members, periods, [(1, day(30)), (3, day(30))])
    cohort = select_cohort(*tables, disease_codes=["D1"], followup="or_death")
    assert rows(cohort) == {(1, 1, day(0), day(30)): 1}


def test_missing_keys_and_dates_match_nothing(spark):
    tables = frames(
        spark,
        [(None, 1, day(0)), (1, 1, None), (1, None, day(0)), (1, 1, day(0))],
        [(None, day(-900), day(900)), (1, None, day(900)), (1, day(-900), None), (1, day(-900), day(900))],
        [(None, day(5))],
    )
    assert rows(select_cohort(*tables, disease_codes=["D1"])) == {(1, 1, day(0), None): 1}


def test_members_do_not_fan_out(spark):
    conditions, _, _, categories = frames(spark, [(1, 1, day(0)), (1, 9, day(0))], [], [])
    members = cohort_members(conditions, categories, disease_ids=[100, 101])
    assert rows(members) == {(1, 1, day(0)): 1}


def test_repeated_occurrences_stay_compact(spark):
    members = [(1, 1, day(0))] * 500
    tables = frames(spark, members, [(1, day(-900), day(900))] * 3, [])
    assert [tuple(row) for row in count_cohort(*tables, disease_codes=["D1"]).collect()] == [
        (1, 1, day(0), None, 1500)
    ]
    assert select_cohort(*tables, disease_codes=["D1"]).count() == 1500


@pytest.mark.parametrize("options", [{"label": "as_written"}, {"label": "as_written", "label_days": 30}, {}, {"followup": "or_death"}], ids=str)
@pytest.mark.parametrize("seed", [1, 2])
def test_summed_deaths_keep_target_and_counts(spark, seed, options):
    members, periods, deaths, _ = random_history(seed)
    deaths = [*deaths, (0, None), (None, day(3))]
    tables = frames(spark, members, periods, deaths)
    each = select_cohort(*tables, disease_codes=["D1"], **options).collect()
    expected = {}
    for person, concept, onset, died in each:
        days, n = expected.get((person, concept, onset), (set(), 0))
        expected[person, concept, onset] = (days | ({died} - {None}), n + 1)
    summed = count_cohort(*tables, disease_codes=["D1"], deaths="summed", **options).collect()
    assert {tuple(r)[:3]: (r.death_date, r.row_count) for r in summed} == {
        key: (min(days, default=None), n) for key, (days, n) in expected.items()
    }
    assert len(summed) == len(expected) and any(r.death_date for r in summed)


def test_many_onsets_and_deaths_of_one_person_make_no_pairs(spark):
    n = 10_000
    conditions, periods, deaths, categories = frames(spark, [(1, 1, day(0))], [(1, day(-500), day(3 * n))], [])
    conditions = spark.range(n).selectExpr(
        "1L AS person_id", "1L AS condition_concept_id", "date_add(DATE'2000-01-01', CAST(id AS INT)) AS condition_start_date"
    )
    deaths = spark.range(n).selectExpr("1L AS person_id", "date_add(DATE'2000-01-01', CAST(id AS INT)) AS death_date")
    cohort = count_cohort(conditions, periods, deaths, categories, disease_codes=["D1"], label="as_written", deaths="summed")
    assert "death_date" not in " ".join(
        line for line in cohort._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line
    )
    found = {(r.disease_start_date - day(0)).days: (r.death_date, r.row_count) for r in cohort.collect()}
    assert found == {i: (day(0) if i > 360 else None, max(i - 360, 1)) for i in range(n)}


def test_first_onset_as_written(spark):
    periods = [(1, day(-900), day(2000))]
    tables = frames(spark, [(1, 1, day(400)), (1, 1, day(500))], periods, [(1, day(20)), (1, day(10)), (1, day(100))])
    cohort = select_cohort(*tables, disease_codes=["D1"], label="as_written", onset="first")
    assert rows(cohort) == {(1, 1, day(400), day(10)): 1}


def test_options_are_checked(spark):
    tables = frames(spark, [(1, 1, day(0))], [(1, day(-900), day(900))], [])
    for options in (
        {},
        {"disease_codes": ["D1"], "disease_ids": [100]},
        {"disease_codes": ["D1"], "label": "later"},
        {"disease_codes": ["D1"], "onset": "last"},
        {"disease_codes": ["D1"], "deaths": "summed"},
        {"disease_codes": ["D1"], "deaths": "none"},
        {"disease_codes": ["D1"], "followup": "or_death", "label": "as_written"},
    ):
        with pytest.raises(ValueError):
            select_cohort(*tables, **options)
