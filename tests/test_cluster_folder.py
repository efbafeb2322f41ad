"""Queries that stage tables, on what looks like a cluster whose shared checkpoint folder is named without a scheme."""

from __future__ import annotations

import duckdb
import pytest
from oracle import spark_rows, sql_rows

import __spark_entry__ as registry
from onsetlab.sources import staging

# Some patients with ten orders each, so that brands, nations and dates meet in every query.
ROWS = {
    "region": "SELECT CAST(i AS INT) AS r_regionkey, 'REGION_' || i AS r_name FROM range(5) t(i)",
    "nation": """
        SELECT CAST(i AS INT) AS n_nationkey, 'NATION_' || i AS n_name, CAST(i % 5 AS INT) AS n_regionkey
        FROM range(25) t(i)""",
    "customer": "SELECT i AS c_custkey, CAST(i % 25 AS INT) AS c_nationkey FROM range(120) t(i)",
    "supplier": "SELECT i AS s_suppkey, CAST(i % 25 AS INT) AS s_nationkey FROM range(60) t(i)",
    "part": """
        SELECT i AS p_partkey, 'Brand#' || (1 + i % 25) AS p_brand, CAST(1 + i % 47 AS INT) AS p_size
        FROM range(150) t(i)""",
    "orders": """
        SELECT i AS o_orderkey, i % 120 AS o_custkey, CASE WHEN i % 3 = 0 THEN 'F' ELSE 'O' END AS o_orderstatus,
               CAST(DATE '1992-01-01' + CAST(i * 7919 % 2399 AS INT) AS TIMESTAMP) AS o_orderdate
        FROM range(1200) t(i)""",
    "lineitem": """
        SELECT i // 3 AS l_orderkey, (i * 31 + i * i // 40) % 150 AS l_partkey, i * 17 % 60 AS l_suppkey,
               CAST(1 + i * 13 % 7 AS INT) AS l_linenumber, ['N', 'R', 'A'][1 + i * i % 7 % 3] AS l_returnflag,
               CAST(DATE '1992-01-01' + CAST((i // 3) * 7919 % 2399 + i * 37 % 120 AS INT) AS TIMESTAMP) AS l_shipdate
        FROM range(3600) t(i)""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    with duckdb.connect() as connection:
        for name, rows in ROWS.items():
            connection.execute(f"COPY ({rows}) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return path


@pytest.fixture(scope="module")
def connection(folder):
    with duckdb.connect() as connection:
        for name in ROWS:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
        yield connection


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """A folder without a scheme; until the module ends the session takes it and is on a cluster, as far as its master tells."""
    path = tmp_path_factory.mktemp("shared")
    with pytest.MonkeyPatch.context() as patch:
        # The real setting cannot change while a session runs, and the session's stages may be open.
        patch.setattr(staging, "CHECKPOINT_SETTING", "onsetlab.tests.folder")
        patch.setattr(staging, "_OF_SESSION", {})
        patch.setattr(spark, "stop", spark.stop)
        patch.setattr(spark.sparkContext, "master", "spark://host:7077")
        spark.conf.set(staging.CHECKPOINT_SETTING, str(path))
        yield path
        for stages in staging._OF_SESSION.values():
            stages.close()
        spark.conf.unset(staging.CHECKPOINT_SETTING)
    assert not list(path.iterdir())


STAGING = [
    "cohort",
    "cohort_as_written",
    "cohort_first_onset",
    "cohort_by_id",
    "cohort_members",
    "cohort_targets",
    "cohort_or_death",
    "common_conditions",
    "condition_counts",
    "common_drugs",
    "condition_lookback",
    "dataset_roundtrip",
    "death_csv",
    "condition_pivot",
    "drug_counts",
    "drug_csv",
    "drug_lookback",
    "features_as_written",
    "drug_pivot",
    "features_first_onset",
    "features_person",
    "landing_rejects",
]


@pytest.mark.parametrize("name", STAGING)
def test_a_query_stages_in_a_shared_folder_without_a_scheme(name, spark, folder, shared, connection):
    columns, rows = spark_rows(registry.queries()[name](spark, str(folder)))
    expected_columns, expected = sql_rows(connection, registry.oracle_sql()[name])
    assert list(shared.glob("job-*/*"))
    assert columns == expected_columns
    assert rows == expected
    assert rows
