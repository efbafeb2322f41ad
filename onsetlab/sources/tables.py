"""Reading patient and vocabulary tables, by catalog name or by path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlab.functions.dates import cast_date_columns
from onsetlab.sources.contracts import broken_rules, landing_schema, text_schema, typed
from onsetlab.sources.staging import Stages

# Default databases, and how physical table names are formed.
PATIENT_DATABASE = "cmsdesynpuf1k"
VOCABULARY_DATABASE = "vocab-omop"
PATIENT_TABLE = "cdm_{table}_csv_bz2"
VOCABULARY_TABLE = "{table}_csv"


def check_table_exists(spark: SparkSession, table: str, database: str) -> None:
    """Raise ``ValueError`` unless exactly one table or view has this name."""
    quoted = f"`{database}`"
    known = spark.catalog.databaseExists(quoted)
    listed = spark.catalog.listTables(quoted, table) if known else []
    matches = [entry for entry in listed if entry.name.lower() == table.lower()]
    if not matches:
        raise ValueError(f"Table {table} not found")
    if len(matches) > 1:
        raise ValueError(f"Multiple tables found for {table}")


def load_table(spark: SparkSession, table: str, database: str) -> DataFrame:
    """Check that the table is there, then scan it through the catalog."""
    check_table_exists(spark, table, database)
    return spark.table(f"`{database}`.`{table}`")


def read_landing_csv(
    spark: SparkSession, path: str, contract: T.StructType, **options: str
) -> DataFrame:
    """Scan a landed CSV file or folder with declared types.

    The codec follows the file extension; bzip2 files are split between tasks
    as long as records do not span lines. No pass over the data is spent on
    inferring types. ``options`` go to the CSV reader (delimiter, header, ...).
    """
    reader = spark.read.schema(landing_schema(contract))
    return reader.options(**{"header": "true", "enforceSchema": "false", **options}).csv(path)


@dataclass(frozen=True)
class Landed:
    """The rows of a scan that keep their contract, and the records that do not."""

    rows: DataFrame
    rejects: DataFrame


REJECTING = ("number_format", "date_format")
_FAULTS, _RECORD, _FILE = "_landing_faults", "_landing_record", "_landing_file"


def read_landing_with_rejects(
    spark: SparkSession,
    path: str,
    contract: T.StructType,
    rules: Sequence[str] = REJECTING,
    stages: Stages | None = None,
    **options: str,
) -> Landed:
    """:func:`read_landing_csv`, with the malformed records in a frame of their own.

    ``rows`` have the landing types, and ``rejects`` are ``file, record,
    reasons``: the file a record came from, the record as it stands there (put
    together again from its fields where it has the right number of them) and an
    array of what is wrong, sorted by the contract's columns. A record with too
    few or too many fields has the reason ``fields``. ``rules`` are those of
    :func:`~onsetlab.sources.contracts.check_contract` that a value must not
    break: ``number_format`` and ``date_format``, and if wished ``required`` and
    ``max_length``. Every record is in one of the two frames, an empty line in
    neither.

    With ``stages`` the files are read once, for both frames; without, each of
    them reads the files when it is used.
    """
    if {_FAULTS, _RECORD, _FILE} & set(contract.names):
        raise ValueError(f"a contract has no columns {_FAULTS}, {_RECORD} or {_FILE}")
    # As text, so that only the number of fields makes a record malformed; all
    # columns are read whatever is asked for, or no field would be missed.
    fixed = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD, "columnPruning": "false"}
    schema = T.StructType([*text_schema(contract).fields, T.StructField(_RECORD, T.StringType())])
    reader = spark.read.schema(schema).options(**{"header": "true", "enforceSchema": "false", **options, **fixed})
    read = reader.csv(path).select("*", F.col("_metadata.file_path").alias(_FILE))
    fields = F.when(F.col(_RECORD).isNotNull(), F.array(F.lit("fields")))
    tagged = read.withColumn(_FAULTS, F.coalesce(fields, broken_rules(read, contract, rules)))
    if stages is not None:
        tagged = stages.stage(tagged, "landed")
    shape = {name: options[name] for name in ("sep", "delimiter", "quote", "escape", "nullValue") if name in options}
    record = F.coalesce(_RECORD, F.to_csv(F.struct(*contract.names), shape))
    return Landed(
        typed(tagged.filter(F.size(_FAULTS) == 0).select(*contract.names), contract),
        tagged.filter(F.size(_FAULTS) > 0).select(
            F.col(_FILE).alias("file"), record.alias("record"), F.col(_FAULTS).alias("reasons")
        ),
    )


def patient_table(df: DataFrame) -> DataFrame:
    """A landed patient table with its dates normalised."""
    return cast_date_columns(df)


def create_patient_view(
    spark: SparkSession,
    table: str,
    database: str = PATIENT_DATABASE,
    view: str | None = None,
) -> DataFrame:
    """Scan a patient table, normalise its dates, and register it as a view.

    ``view`` gives the logical name where it differs from the physical one, as
    for a drug table that is landed under a versioned name.
    """
    df = patient_table(load_table(spark, PATIENT_TABLE.format(table=table), database))
    df.createOrReplaceTempView(view or table)
    return df


def create_vocabulary_view(
    spark: SparkSession, table: str, database: str = VOCABULARY_DATABASE
) -> DataFrame:
    """Scan a vocabulary table and register it; its dates are left alone."""
    df = load_table(spark, VOCABULARY_TABLE.format(table=table), database)
    df.createOrReplaceTempView(table)
    return df


def create_query_view(
    spark: SparkSession,
    view: str,
    query: str,
    parameters: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run a parameterised query and register its result under a name.

    Parameters are bound as typed literals (``:name`` in the text), never
    pasted into the text. A list is bound as an array: use
    ``array_contains(:codes, column)`` for membership.
    """
    df = spark.sql(query, args=dict(parameters or {}))
    df.createOrReplaceTempView(view)
    return df
