from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlab.functions.dates import cast_date_columns
from onsetlab.sources import contracts, sinks, staging, tables


def plain(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


LANDED = [(1, "20200229", "x"), (2, "00000000", None), (3, None, "20200101"), (4, "20210229", "")]


@pytest.fixture()
def landed(spark):
    return spark.createDataFrame(LANDED, "person_id long, death_date string, note string")


def test_date_cast_keeps_columns_and_order(landed):
    cast = cast_date_columns(landed)
    assert cast.columns == landed.columns
    assert [row.death_date for row in cast.orderBy("person_id").collect()] == [
        date(2020, 2, 29), None, None, None,
    ]
    assert cast.schema["note"].dataType == T.StringType()


def test_date_cast_of_numbers_and_dates(spark):
    df = spark.sql("SELECT 20200131 AS a_date, DATE'2020-01-31' AS b_date, TIMESTAMP'2020-01-31 10:00:00' AS c_date")
    assert plain(cast_date_columns(df)) == {(date(2020, 1, 31),) * 3: 1}


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    """Landed tables under their physical names, in two databases."""
    folder = tmp_path_factory.mktemp("landing")
    patients, vocabulary = "site", "vocab_test"
    for database in (patients, vocabulary):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder / database}'")
    death = spark.createDataFrame(LANDED, "person_id long, death_date string, note string")
    for table in ("cdm_death_csv_bz2", "cdm_drug_exposure5_2_2_csv_bz2", "cdm_deaths_csv_bz2"):
        path = str(folder / table)
        death.write.option("compression", "bzip2").option("header", "true").csv(path)
        spark.sql(
            f"CREATE TABLE {patients}.{table} (person_id LONG, death_date STRING, note STRING) "
            f"USING csv OPTIONS (path '{path}', header 'true')"
        )
    concept = spark.createDataFrame([(1, "20200101")], "concept_id long, valid_start_date string")
    concept.write.csv(str(folder / "concept"))
    spark.sql(
        f"CREATE TABLE `{vocabulary}`.concept_csv (concept_id LONG, valid_start_date STRING) "
        f"USING csv OPTIONS (path '{folder / 'concept'}')"
    )
    return patients, vocabulary


def test_patient_view_has_dates(spark, catalog):
    view = tables.create_patient_view(spark, "death", catalog[0])
    assert spark.table("death").schema["death_date"].dataType == T.DateType()
    assert view.filter("death_date IS NOT NULL").count() == 1


def test_logical_name_may_differ_from_the_physical_one(spark, catalog):
    tables.create_patient_view(spark, "drug_exposure5_2_2", catalog[0], view="drug_exposure")
    assert spark.table("drug_exposure").count() == len(LANDED)


def test_vocabulary_view_leaves_dates_alone(spark, catalog):
    tables.create_vocabulary_view(spark, "concept", catalog[1])
    assert plain(spark.table("concept")) == {(1, "20200101"): 1}


def test_existence_check(spark, catalog):
    assert tables.check_table_exists(spark, "cdm_death_csv_bz2", catalog[0]) is None
    with pytest.raises(ValueError, match="Table cdm_person_csv_bz2 not found"):
        tables.create_patient_view(spark, "person", catalog[0])
    with pytest.raises(ValueError, match="Table x not found"):
        tables.check_table_exists(spark, "x", "no_such_database")


def test_ambiguous_names_are_refused(spark, catalog):
    spark.range(1).createOrReplaceTempView("cdm_death_csv_bz2")
    try:
        with pytest.raises(ValueError, match="Multiple tables found for cdm_death_csv_bz2"):
            tables.load_table(spark, "cdm_death_csv_bz2", catalog[0])
    finally:
        spark.catalog.dropTempView("cdm_death_csv_bz2")


def test_bzip2_csv_with_other_delimiter(spark, tmp_path):
    contract = contracts.CONTRACTS["observation_period"]
    schema = contracts.landing_schema(contract)
    rows = [(1, 7, "20200101", "20211231", 3), (2, 8, "bad", None, None)]
    path = str(tmp_path / "periods")
    spark.createDataFrame(rows, schema).write.csv(path, sep="\t", header=True, compression="bzip2")
    read = tables.patient_table(tables.read_landing_csv(spark, path, contract, sep="\t"))
    assert plain(read) == {(1, 7, date(2020, 1, 1), date(2021, 12, 31), 3): 1, (2, 8, None, None, None): 1}


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = str(tmp_path / "wrong")
    spark.createDataFrame([(1, 2)], "descendant_concept_id long, ancestor_concept_id long").write.csv(path, header=True)
    contract = T.StructType(contracts.CONTRACTS["concept_ancestor"].fields[:2])
    with pytest.raises(Exception, match="CSV header"):
        tables.read_landing_csv(spark, path, contract).collect()


def test_query_view_binds_parameters(spark):
    spark.range(10).createOrReplaceTempView("numbers")
    query = "SELECT id FROM numbers WHERE array_contains(:wanted, id) AND id > :least"
    view = tables.create_query_view(spark, "wanted_numbers", query, {"wanted": [1, 5, 7], "least": 1})
    assert plain(view) == plain(spark.table("wanted_numbers")) == {(5,): 1, (7,): 1}


def test_contract_finds_planted_violations(spark):
    rows = [
        (1, "20200101", "ok"), (None, "20200101", "x" * 51), (2, "00000000", None), (3, None, "x" * 50),
    ]
    df = spark.createDataFrame(rows, "person_id long, death_date string, cause_source_value string")
    report = contracts.check_contract(df, contracts.CONTRACTS["death"], "death")
    assert plain(report) == {
        ("death", "person_id", "required", 1): 1,
        ("death", "death_date", "required", 1): 1,
        ("death", "death_date", "date_format", 1): 1,
        ("death", "cause_source_value", "max_length", 1): 1,
    }


def test_contract_without_a_rule_is_an_error(spark):
    with pytest.raises(ValueError):
        optional = T.StructType([T.StructField("note", T.StringType())])
        contracts.check_contract(spark.range(1), optional, "notes")


def test_contract_finds_absent_columns_unfit_types_and_malformed_numbers(spark):
    df = spark.createDataFrame([("1", 1.5), ("19x0", 2.0), (None, 3.0)], "person_id string, death_date double")
    report = plain(contracts.check_contract(df, contracts.CONTRACTS["death"], "death"))
    assert report[("death", "person_id", "number_format", 1)] == 1
    assert report[("death", "person_id", "required", 1)] == 1
    assert report[("death", "death_date", "type", 1)] == 1
    missing = contracts.check_contract(df.drop("death_date"), contracts.CONTRACTS["death"], "death")
    assert plain(missing)[("death", "death_date", "missing_column", 1)] == 1


def test_text_is_typed_by_the_contract(spark):
    contract = T.StructType(contracts.CONTRACTS["death"].fields[:2])
    df = spark.createDataFrame([("7", "20200101"), ("x", None)], contracts.text_schema(contract))
    assert plain(contracts.typed(df, contract)) == {(7, "20200101"): 1, (None, None): 1}


def test_one_name_may_be_staged_twice(spark):
    with staging.Stages(spark) as stages:
        first = stages.stage(spark.range(2), "numbers")
        second = stages.stage(spark.range(3), "numbers")
        assert (first.count(), second.count()) == (2, 3)


def test_a_machine_local_folder_is_refused_on_a_cluster(spark, monkeypatch):
    class Cluster:
        sparkContext = type("C", (), {"master": "yarn", "getCheckpointDir": staticmethod(lambda: None)})
        conf = type("F", (), {"get": staticmethod(lambda key, default=None: "/tmp/here")})
        _jsc = spark._jsc

    with pytest.raises(RuntimeError, match="own disk"):
        staging.scratch_dir(Cluster())


class SharedCluster:
    """The test session as if on a cluster, with a checkpoint folder named without a scheme."""

    def __init__(self, spark, folder):
        own = spark.sparkContext
        self.sparkContext = type("C", (), {
            "master": "spark://host:7077", "applicationId": f"app-{folder}", "defaultParallelism": own.defaultParallelism,
            "getCheckpointDir": staticmethod(lambda: None),
        })
        self.conf = {staging.CHECKPOINT_SETTING: folder}
        self.range, self.read, self._jsc, self._jvm = spark.range, spark.read, spark._jsc, spark._jvm


def test_a_folder_without_a_scheme_that_all_machines_share_is_taken(spark, tmp_path):
    shared = SharedCluster(spark, str(tmp_path))
    stages = staging.Stages(shared)
    assert stages.root.startswith(f"{tmp_path}/job-")
    staged = stages.stage(spark.range(3), "numbers")
    assert plain(staged) == {(i,): 1 for i in range(3)}
    stages.close()
    assert not list(tmp_path.iterdir())


def test_a_folder_that_loses_what_tasks_write_is_refused(spark, tmp_path):
    lossy = SharedCluster(spark, str(tmp_path))
    # Half of the tasks write to a disk of their own: the driver does not find their rows.
    lossy.range = lambda first, last, step, parts: spark.range(first, last // 2, step, parts)
    with pytest.raises(RuntimeError, match="own disk"):
        staging.scratch_dir(lossy)
    assert not list(tmp_path.iterdir())


def test_contracts_from_a_field_list():
    fields = [
        ("VISIT_OCCURRENCE", "visit_occurrence_id", "Yes", "integer"),
        ("VISIT_OCCURRENCE", "visit_concept_id", "Yes", "Integer"),
        ("VISIT_OCCURRENCE", "visit_start_date", "Yes", "date"),
        ("VISIT_OCCURRENCE", "visit_end_datetime", "No", "datetime"),
        ("VISIT_OCCURRENCE", "visit_source_value", "No", "varchar(50)"),
        ("NOTE", "note_text", "Yes", "varchar(MAX)"),
        ("NOTE", "note_event_id", "No", "bigint"),
        ("COST", "total_charge", "No", "float"),
        ("NOTE_NLP", '"offset"', "No", "varchar(50)"),
    ]
    keys = ("cdmTableName", "cdmFieldName", "isRequired", "cdmDatatype")
    built = contracts.contracts_from_field_list([dict(zip(keys, field)) for field in fields])
    assert set(built) == {"visit_occurrence", "note", "cost", "note_nlp"}
    visit = built["visit_occurrence"]
    assert [field.dataType for field in visit] == [
        T.LongType(), T.IntegerType(), T.DateType(), T.TimestampNTZType(), T.VarcharType(50),
    ]
    assert [field.nullable for field in visit] == [False, False, False, True, True]
    assert built["note"]["note_text"].dataType == T.StringType()
    assert built["note_nlp"].names == ["offset"]
    landing = contracts.landing_schema(visit)
    assert [landing[name].dataType for name in ("visit_start_date", "visit_source_value")] == [T.StringType()] * 2
    with pytest.raises(ValueError):
        contracts.contracts_from_field_list([dict(zip(keys, ("T", "c", "No", "blob")))])


DDL = """
-- CREATE TABLE commented_out (id integer);
/* of two
   lines: CREATE TABLE neither (id integer) */
CREATE TABLE @schema.WARD (
    ward_id integer NOT NULL,  -- a key, with a comma
    ward_concept_id Integer NOT NULL DEFAULT (0),
    condition_concept_id int NULL,
    opened_date date DEFAULT '2000-01-01, or so (the first)' NOT NULL,
    closed_datetime datetime NULL,
    seen TIMESTAMP,
    beds float NULL, share double precision, weight real,
    "offset" varchar ( 50 ) NULL,
    [note_text] varchar(MAX) CHECK (length(note_text) > 3 AND note_text <> 'a,b'),
    remark text,
    big bigint REFERENCES other (id),
    CONSTRAINT ward_key PRIMARY KEY (ward_id, "big"),
    FOREIGN KEY (ward_concept_id) REFERENCES concept (concept_id) );
ALTER TABLE ward ADD CONSTRAINT x UNIQUE (ward_id);
create table if not exists `db`.`Bed`(bed_id bigint primary key,name varchar(5) not  null)
"""


def test_contracts_from_ddl():
    built = contracts.contracts_from_ddl(DDL)
    assert set(built) == {"ward", "bed"}
    assert [(f.name, f.dataType, f.nullable) for f in built["ward"]] == [
        ("ward_id", T.LongType(), False),
        ("ward_concept_id", T.IntegerType(), False),
        ("condition_concept_id", T.LongType(), True),
        ("opened_date", T.DateType(), False),
        ("closed_datetime", T.TimestampNTZType(), True),
        ("seen", T.TimestampNTZType(), True),
        ("beds", T.DoubleType(), True),
        ("share", T.DoubleType(), True),
        ("weight", T.DoubleType(), True),
        ("offset", T.VarcharType(50), True),
        ("note_text", T.StringType(), True),
        ("remark", T.StringType(), True),
        ("big", T.LongType(), False),
    ]
    assert [(f.name, f.dataType, f.nullable) for f in built["bed"]] == [
        ("bed_id", T.LongType(), False), ("name", T.VarcharType(5), False),
    ]
    assert contracts.contracts_from_ddl("SELECT 1") == {}
    for wrong in ("CREATE TABLE t (a blob)", "CREATE TABLE t (a)", "CREATE TABLE t (a integer"):
        with pytest.raises(ValueError):
            contracts.contracts_from_ddl(wrong)


def test_ddl_of_the_contracts_gives_the_contracts():
    words = {
        T.LongType(): "bigint", T.IntegerType(): "integer", T.DoubleType(): "float", T.DateType(): "date",
        T.TimestampNTZType(): "datetime", T.StringType(): "varchar(max)",
    }

    def declared(field):
        kind = f"varchar({field.dataType.length})" if isinstance(field.dataType, T.VarcharType) else words[field.dataType]
        return f"    {field.name} {kind} {'NULL' if field.nullable else 'NOT NULL'}"

    text = ";\n".join(
        f"CREATE TABLE main.{table.upper()} (\n" + ",\n".join(declared(f) for f in contract) + " )"
        for table, contract in contracts.CONTRACTS.items()
    )
    assert contracts.contracts_from_ddl(text) == contracts.CONTRACTS


WARD = contracts.contracts_from_ddl("CREATE TABLE ward (ward_id bigint NOT NULL, beds float, opened_date date, name varchar(5))")["ward"]
LINES = {
    "a.csv": ["1,2.5,20200101,east", "2,many,20200101,west", "3,,20200230,", "4,1,20200101", '5,1,20200101,"a,b"'],
    "b.csv": ["x,y,z,w", "7,1,20200101,west,north", ",1,20200101,none", "9,1,20200101,longer", ""],
}


def land(folder):
    folder.mkdir(exist_ok=True)
    for name, lines in LINES.items():
        (folder / name).write_text("\n".join(["ward_id,beds,opened_date,name", *lines]) + "\n")
    return str(folder)


@pytest.mark.parametrize("staged", [True, False])
def test_rejects_have_file_record_and_reasons(spark, tmp_path, staged):
    path = land(tmp_path / "landing")
    with staging.Stages(spark) as stages:
        landed = tables.read_landing_with_rejects(spark, path, WARD, stages=stages if staged else None)
        assert landed.rows.schema == contracts.landing_schema(WARD)
        good = {(1, 2.5, "20200101", "east"), (5, 1.0, "20200101", "a,b"), (None, 1.0, "20200101", "none"), (9, 1.0, "20200101", "longer")}
        assert {tuple(r) for r in landed.rows.collect()} == good
        rejects = {(r.file.rsplit("/", 1)[1], r.record): r.reasons for r in landed.rejects.collect()}
        assert rejects == {
            ("a.csv", "2,many,20200101,west"): ["beds: number_format"],
            ("a.csv", "3,,20200230,"): ["opened_date: date_format"],
            ("a.csv", "4,1,20200101"): ["fields"],
            ("b.csv", "x,y,z,w"): ["ward_id: number_format", "beds: number_format", "opened_date: date_format"],
            ("b.csv", "7,1,20200101,west,north"): ["fields"],
        }
        # Whatever is asked of them, every line but the empty one is in one of the two.
        assert landed.rows.count() + landed.rejects.count() == 9
        assert landed.rows.select("name").count() == 4 and landed.rejects.select("file").count() == 5


def test_rules_say_what_is_rejected(spark, tmp_path):
    path = land(tmp_path / "landing")
    strict = tables.read_landing_with_rejects(spark, path, WARD, ["required", "max_length"])
    assert sorted(r.reasons for r in strict.rejects.collect()) == [
        ["fields"], ["fields"], ["name: max_length"], ["ward_id: required"],
    ]
    # A malformed value that is let through becomes NULL, as in the plain reader.
    assert (2, None) in {(r.ward_id, r.beds) for r in strict.rows.collect()}
    none = tables.read_landing_with_rejects(spark, path, WARD, [])
    assert [r.reasons for r in none.rejects.collect()] == [["fields"]] * 2


def test_staged_rejects_read_the_files_once(spark, tmp_path):
    path = land(tmp_path / "landing")
    with staging.Stages(spark) as stages:
        landed = tables.read_landing_with_rejects(spark, path, WARD, stages=stages)
        for df in (landed.rows, landed.rejects):
            assert all("job-" in name for name in df.inputFiles())


def test_sizes_of_the_contracts():
    sizes = {table: len(contract) for table, contract in contracts.CONTRACTS.items()}
    assert sizes == {
        "person": 18, "observation_period": 5, "condition_occurrence": 16, "drug_exposure": 23,
        "death": 7, "concept": 10, "concept_ancestor": 4,
    }


def test_dataset_is_replaced_with_its_table(spark, tmp_path):
    path = str(tmp_path / "train")
    sinks.write_dataset(spark.range(10), path, "train_data")
    sinks.write_dataset(spark.range(3).selectExpr("id", "id * 2 AS twice"), path, "train_data")
    expected = {(i, 2 * i): 1 for i in range(3)}
    assert plain(spark.table("train_data")) == plain(sinks.read_dataset(spark, path)) == expected
    spark.sql("DROP TABLE train_data")
    assert sinks.read_dataset(spark, path).count() == 3


def failing(df, at):
    return df.selectExpr(f"CASE WHEN id = {at} THEN CAST(raise_error('broken') AS BIGINT) ELSE id END AS id")


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "train")
    sinks.write_dataset(spark.range(10), path, "kept_data")
    with pytest.raises(Exception, match="broken"):
        sinks.write_dataset(failing(spark.range(0, 1000, 1, 8), 700), path, "kept_data")
    expected = {(i,): 1 for i in range(10)}
    assert plain(spark.table("kept_data")) == plain(sinks.read_dataset(spark, path)) == expected
    # Nothing is left of the failed version.
    assert len(list((tmp_path / "train").glob("v*"))) == 1
    sinks.write_dataset(spark.range(3), path, "kept_data")
    assert spark.table("kept_data").count() == sinks.read_dataset(spark, path).count() == 3
    spark.sql("DROP TABLE kept_data")


def test_new_columns_reach_the_catalog_and_changed_ones_too(spark, tmp_path):
    path = str(tmp_path / "train")
    sinks.write_dataset(spark.range(2), path, "wide_data")
    sinks.write_dataset(spark.range(2).selectExpr("id", "'x' AS more"), path, "wide_data")
    assert dict(spark.table("wide_data").dtypes) == {"id": "bigint", "more": "string"}
    sinks.write_dataset(spark.range(2).selectExpr("CAST(id AS STRING) AS id"), path, "wide_data")
    assert dict(spark.table("wide_data").dtypes) == {"id": "string"}
    assert plain(spark.table("wide_data")) == {("0",): 1, ("1",): 1}
    spark.sql("DROP TABLE wide_data")


def test_older_versions_stay_for_their_readers(spark, tmp_path):
    path = str(tmp_path / "train")
    sinks.write_dataset(spark.range(5), path)
    old = sinks.read_dataset(spark, path)
    sinks.write_dataset(spark.range(7), path)
    assert (old.count(), sinks.read_dataset(spark, path).count()) == (5, 7)
    sinks.write_dataset(spark.range(9), path, keep=0)
    assert len(list((tmp_path / "train").glob("v*"))) == 1


def test_plain_files_are_read_too(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert sinks.read_dataset(spark, str(tmp_path / "plain")).count() == 4


def test_staged_tables_tell_their_size(spark):
    with staging.Stages(spark) as stages:
        staged = stages.stage(spark.range(5).selectExpr("id", "'abc' AS text"), "numbers", F.max("id").alias("top"))
        assert staging.measured(staged) == {"rows": 5, "bytes": 5 * (32 + 8 + 3), "top": 4}
        assert staging.measured(staged.where("id > 2")) is None
        assert staging.measured(stages.stage(staged.where("false"), "none"))["bytes"] == 0


def test_staged_tables_are_read_back_and_removed(spark):
    with staging.Stages(spark) as stages:
        staged = stages.stage(spark.range(5), "numbers")
        assert stages.root.startswith(staging.scratch_dir(spark))
        assert plain(staged) == {(i,): 1 for i in range(5)}
    with pytest.raises(Exception):
        spark.read.parquet(f"{stages.root}/numbers")


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, configured, context):
        self.conf = {staging.CHECKPOINT_SETTING: configured} if configured else {}
        self.sparkContext = context


def test_scratch_folder_is_the_sessions_own():
    assert staging.scratch_dir(FakeSession("hdfs:///scratch/", FakeContext("yarn"))) == "hdfs:///scratch"
    assert staging.scratch_dir(FakeSession(None, FakeContext("yarn", "s3a://shared/a"))) == "s3a://shared/a"
    with pytest.raises(RuntimeError):
        staging.scratch_dir(FakeSession(None, FakeContext("yarn")))
    local = FakeSession(None, FakeContext("local[2]"))
    assert staging.scratch_dir(local) == staging.scratch_dir(local) == local.sparkContext.folder


def test_stages_remove_folders_written_by_other_means(spark, tmp_path):
    other = tmp_path / "other"
    with staging.Stages(spark) as stages:
        spark.range(3).write.parquet(str(other))
        stages.also_remove(str(other))
        assert other.exists()
    assert not other.exists()
