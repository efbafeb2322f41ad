"""Registered queries against their SQL on the same files."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle import duck, spark_rows, sql_rows

import __spark_entry__ as registry

# Queries of subpackages that may be absent have tests of their own.
ORACLES = {name: sql for name, sql in registry.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, clinic, connection):
    columns, rows = spark_rows(registry.QUERIES[name](clinic))
    expected_columns, expected = sql_rows(connection, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registry.QUERIES)
    assert set(registry.QUERIES) - set(ORACLES) == {"risk_scores", "model_metrics"}


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() == 145


def test_risk_scores_are_probabilities(clinic):
    scores = registry.risk_scores(clinic).collect()
    assert len(scores) == 145
    assert all(0 <= row.risk <= 1 for row in scores)


def test_metrics_cover_the_test_rows(clinic):
    rows = registry.model_metrics(clinic).collect()
    values = {(row.metric, row.name): row.value for row in rows}
    assert 0 <= values["area", "areaUnderROC"] <= 1
    assert sum(v for (metric, _), v in values.items() if metric == "confusion") > 0
    assert sum(v for (metric, _), v in values.items() if metric == "importance") == pytest.approx(1)
