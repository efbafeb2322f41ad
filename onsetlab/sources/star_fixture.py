"""Clinical tables derived from the star-schema test tables.

A customer plays a patient, a line item an event, a part a condition concept
(with its brand and a five-brand chapter as ancestors) and a supplier a drug
concept (with its nation and region as ancestors). The texts run unchanged in
Spark SQL and other SQL engines; braces name the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# In dependency order: a view may read base tables and earlier views.
VIEWS: dict[str, str] = {
    "person": """
        SELECT c_custkey AS person_id,
               8507 + 25 * (c_custkey % 2) AS gender_concept_id,
               1920 + c_custkey % 60 AS year_of_birth,
               8515 + c_nationkey % 3 AS race_concept_id
        FROM {customer}""",
    "death": """
        SELECT o_custkey AS person_id, CAST(MAX(o_orderdate) AS DATE) AS death_date
        FROM {orders} WHERE o_orderstatus = 'F' AND o_custkey % 2 = 0
        GROUP BY o_custkey""",
    "observation_period": """
        SELECT o_custkey AS person_id,
               CAST(MIN(o_orderdate) AS DATE) AS observation_period_start_date,
               CAST(MAX(o_orderdate) AS DATE) AS observation_period_end_date
        FROM {orders} GROUP BY o_custkey
        UNION ALL
        SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE)
        FROM {orders} WHERE o_custkey % 10 = 0 GROUP BY o_custkey""",
    "condition_occurrence": """
        SELECT o_custkey AS person_id, 1000000 + l_partkey AS condition_concept_id,
               CAST(l_shipdate AS DATE) AS condition_start_date
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
        WHERE l_returnflag <> 'R'""",
    "drug_exposure": """
        SELECT o_custkey AS person_id, 2000000 + l_suppkey AS drug_concept_id,
               CAST(l_shipdate AS DATE) AS drug_exposure_start_date
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
        WHERE l_returnflag = 'R'""",
    "part_brand": """
        SELECT p_partkey, p_size, p_brand, CAST(substr(p_brand, 7) AS INT) AS b,
               CAST(floor((CAST(substr(p_brand, 7) AS INT) - 1) / 5) AS INT) AS ch
        FROM {part}""",
    "concept": """
        SELECT DISTINCT CAST(3000000 + b AS BIGINT) AS concept_id, p_brand AS concept_name,
               concat('B', lpad(CAST(b AS STRING), 2, '0')) AS concept_code,
               'ICD10' AS vocabulary_id, 'ICD10 Hierarchy' AS concept_class_id,
               'Condition' AS domain_id
        FROM {part_brand}
        UNION ALL
        SELECT DISTINCT CAST(3100000 + ch AS BIGINT), concat('Chapter ', CAST(ch AS STRING)),
               concat('CH', CAST(ch AS STRING)), 'ICD10', 'ICD10 Hierarchy', 'Condition'
        FROM {part_brand}
        UNION ALL
        SELECT CAST(4000000 + n_nationkey AS BIGINT), n_name,
               concat('N', lpad(CAST(n_nationkey AS STRING), 2, '0')), 'ATC', 'ATC 2nd', 'Drug'
        FROM {nation}
        UNION ALL
        SELECT CAST(4100000 + r_regionkey AS BIGINT), r_name,
               concat('R', CAST(r_regionkey AS STRING)), 'ATC', 'ATC 1st', 'Drug'
        FROM {region}""",
    "concept_ancestor": """
        SELECT CAST(3000000 + b AS BIGINT) AS ancestor_concept_id,
               1000000 + p_partkey AS descendant_concept_id
        FROM {part_brand} WHERE p_size % 10 <> 0
        UNION ALL
        SELECT CAST(3100000 + ch AS BIGINT), 1000000 + p_partkey
        FROM {part_brand} WHERE p_size % 10 <> 0
        UNION ALL
        SELECT CAST(4000000 + s_nationkey AS BIGINT), 2000000 + s_suppkey
        FROM {supplier} WHERE s_suppkey % 7 <> 0
        UNION ALL
        SELECT CAST(4100000 + n_regionkey AS BIGINT), 2000000 + s_suppkey
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
        WHERE s_suppkey % 7 <> 0""",
    "landing_condition": """
        SELECT o_custkey AS person_id, 1000000 + l_partkey AS condition_concept_id,
               CASE WHEN l_linenumber = 7 THEN '00000000'
                    ELSE replace(substr(CAST(l_shipdate AS STRING), 1, 10), '-', '')
               END AS condition_start_date
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
        WHERE l_returnflag <> 'R'""",
    "landing_drug": """
        SELECT o_custkey AS person_id, 2000000 + l_suppkey AS drug_concept_id,
               CASE WHEN l_linenumber = 7 THEN '1998-1-1'
                    ELSE replace(substr(CAST(l_shipdate AS STRING), 1, 10), '-', '')
               END AS drug_exposure_start_date
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
        WHERE l_returnflag = 'R'""",
    "landing_death": """
        SELECT person_id, CASE WHEN person_id % 50 = 0 THEN '19981301'
                    ELSE replace(substr(CAST(death_date AS STRING), 1, 10), '-', '')
               END AS death_date
        FROM {death}""",
    "landing_period": """
        SELECT person_id,
               replace(substr(CAST(observation_period_start_date AS STRING), 1, 10), '-', '')
                   AS observation_period_start_date,
               CASE WHEN person_id % 70 = 0 THEN ''
                    ELSE replace(substr(CAST(observation_period_end_date AS STRING), 1, 10), '-', '')
               END AS observation_period_end_date
        FROM {observation_period}""",
    "landing_person": """
        SELECT CAST(person_id AS STRING) AS person_id,
               CAST(gender_concept_id AS STRING) AS gender_concept_id,
               CASE WHEN person_id % 40 = 0 THEN '19x0' ELSE CAST(year_of_birth AS STRING)
               END AS year_of_birth,
               CAST(race_concept_id AS STRING) AS race_concept_id
        FROM {person}""",
}


def inputs_of(view: str) -> list[str]:
    """The tables and views a view reads."""
    return [name for name in (*BASE_TABLES, *VIEWS) if "{%s}" % name in VIEWS[view]]


class StarFixture:
    """The clinical views over one folder of test tables, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                inputs = {source: self[source] for source in inputs_of(name)}
                self._frames[name] = self.spark.sql(VIEWS[name], **inputs)
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]


def view_ctes(*views: str) -> str:
    """The text of a WITH list that defines the views, and those they read."""
    needed: set[str] = set()

    def visit(view: str) -> None:
        needed.add(view)
        for source in inputs_of(view):
            if source in VIEWS:
                visit(source)

    for view in views:
        visit(view)
    names = {name: name for name in (*BASE_TABLES, *VIEWS)}
    return ",\n".join(
        f"{view} AS ({text.format(**names)})" for view, text in VIEWS.items() if view in needed
    )
