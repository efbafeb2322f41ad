"""Declared columns, types and required values of the tables the job reads."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onsetlab.functions.dates import is_date_column, rejected_date


# The concept columns that the job joins on.
JOINED_CONCEPTS = (
    "concept_id",
    "condition_concept_id",
    "drug_concept_id",
    "ancestor_concept_id",
    "descendant_concept_id",
)


def _data_type(column: str, declared: str) -> T.DataType:
    declared = declared.strip().lower()
    text = re.fullmatch(r"varchar\((\d+|max)\)", declared)
    if text:
        length = text.group(1)
        return T.StringType() if length == "max" else T.VarcharType(int(length))
    if declared == "integer":
        # Identifiers and the concepts that events are joined on outgrow 32 bits.
        is_key = column.endswith("_id") and (column in JOINED_CONCEPTS or not column.endswith("_concept_id"))
        return T.LongType() if is_key else T.IntegerType()
    simple: dict[str, T.DataType] = {
        "bigint": T.LongType(),
        "float": T.DoubleType(),
        "date": T.DateType(),
        "datetime": T.TimestampNTZType(),
    }
    if declared not in simple:
        raise ValueError(f"no type for {declared!r} of column {column}")
    return simple[declared]


def _contract(columns: str) -> T.StructType:
    fields = []
    for line in columns.strip().splitlines():
        name, declared, *required = line.split()
        fields.append(T.StructField(name, _data_type(name, declared), not required))
    return T.StructType(fields)


# The OMOP Common Data Model 5.4 contracts of the tables the job
# reads, one column per line. Keys that are joined on are 64-bit.
_COLUMNS: dict[str, str] = {
    "person": """
        person_id bigint required
        gender_concept_id integer required
        year_of_birth integer required
        month_of_birth integer
        day_of_birth integer
        birth_datetime datetime
        race_concept_id integer required
        ethnicity_concept_id integer required
        location_id bigint
        provider_id bigint
        care_site_id bigint
        person_source_value varchar(50)
        gender_source_value varchar(50)
        gender_source_concept_id integer
        race_source_value varchar(50)
        race_source_concept_id integer
        ethnicity_source_value varchar(50)
        ethnicity_source_concept_id integer
    """,
    "observation_period": """
        observation_period_id bigint required
        person_id bigint required
        observation_period_start_date date required
        observation_period_end_date date required
        period_type_concept_id integer required
    """,
    "condition_occurrence": """
        condition_occurrence_id bigint required
        person_id bigint required
        condition_concept_id bigint required
        condition_start_date date required
        condition_start_datetime datetime
        condition_end_date date
        condition_end_datetime datetime
        condition_type_concept_id integer required
        condition_status_concept_id integer
        stop_reason varchar(20)
        provider_id bigint
        visit_occurrence_id bigint
        visit_detail_id bigint
        condition_source_value varchar(50)
        condition_source_concept_id integer
        condition_status_source_value varchar(50)
    """,
    "drug_exposure": """
        drug_exposure_id bigint required
        person_id bigint required
        drug_concept_id bigint required
        drug_exposure_start_date date required
        drug_exposure_start_datetime datetime
        drug_exposure_end_date date required
        drug_exposure_end_datetime datetime
        verbatim_end_date date
        drug_type_concept_id integer required
        stop_reason varchar(20)
        refills integer
        quantity float
        days_supply integer
        sig varchar(max)
        route_concept_id integer
        lot_number varchar(50)
        provider_id bigint
        visit_occurrence_id bigint
        visit_detail_id bigint
        drug_source_value varchar(50)
        drug_source_concept_id integer
        route_source_value varchar(50)
        dose_unit_source_value varchar(50)
    """,
    "death": """
        person_id bigint required
        death_date date required
        death_datetime datetime
        death_type_concept_id integer
        cause_concept_id integer
        cause_source_value varchar(50)
        cause_source_concept_id integer
    """,
    "concept": """
        concept_id bigint required
        concept_name varchar(255) required
        domain_id varchar(20) required
        vocabulary_id varchar(20) required
        concept_class_id varchar(20) required
        standard_concept varchar(1)
        concept_code varchar(50) required
        valid_start_date date required
        valid_end_date date required
        invalid_reason varchar(1)
    """,
    "concept_ancestor": """
        ancestor_concept_id bigint required
        descendant_concept_id bigint required
        min_levels_of_separation integer required
        max_levels_of_separation integer required
    """,
}


CONTRACTS: dict[str, T.StructType] = {
    table: _contract(columns) for table, columns in _COLUMNS.items()
}


def contracts_from_field_list(
    fields: Iterable[Mapping[str, str]],
) -> dict[str, T.StructType]:
    """Contracts of any set of tables from a field-level specification.

    ``fields`` holds one mapping per column with the keys of the field list that
    is published with the data model (``cdmTableName``, ``cdmFieldName``,
    ``isRequired``, ``cdmDatatype``), for example from ``csv.DictReader``. This
    is how the tables beyond :data:`CONTRACTS` get theirs, or from the data
    model's DDL by :func:`contracts_from_ddl`.
    """
    tables: dict[str, list[T.StructField]] = {}
    for field in fields:
        name = field["cdmFieldName"].strip().strip('"').lower()
        required = field["isRequired"].strip().lower() in ("yes", "true", "1")
        column = T.StructField(name, _data_type(name, field["cdmDatatype"]), not required)
        tables.setdefault(field["cdmTableName"].strip().lower(), []).append(column)
    return {table: T.StructType(columns) for table, columns in tables.items()}


_TABLE = re.compile(r"\bcreate\s+table\s+(?:if\s+not\s+exists\s+)?([^\s(]+)\s*\(", re.IGNORECASE)
_COLUMN = re.compile(r"(\S+)\s+([a-z]+(?:\s+precision)?(?:\s*\([^)]*\))?)(?=\s|$)\s*(.*)", re.IGNORECASE | re.DOTALL)
_CONSTRAINT = re.compile(r"(?:constraint|primary|foreign|unique|check|index|key)\b", re.IGNORECASE)
# Other spellings of the types that contracts are declared in.
_SPELLINGS = {
    "int": "integer",
    "double precision": "float",
    "real": "float",
    "timestamp": "datetime",
    "datetime2": "datetime",
    "text": "varchar(max)",
}


def contracts_from_ddl(text: str) -> dict[str, T.StructType]:
    """Contracts of the tables that a text of ``CREATE TABLE`` statements declares.

    A table goes by the last part of its name, in lower case. A column is
    required if it is declared ``NOT NULL`` or ``PRIMARY KEY``, or if it belongs
    to a table's primary key; other constraints, defaults, comments and
    statements do not matter. A type that no contract can be declared in is an
    error that names the column.
    """
    text = re.sub(r"--[^\n]*|/\*.*?\*/", " ", text, flags=re.DOTALL)
    tables: dict[str, T.StructType] = {}
    for found in _TABLE.finditer(text):
        table = _name(found.group(1).split(".")[-1])
        fields, keys = [], set()
        for part in _parts(text, found.end()):
            if _CONSTRAINT.match(part):
                key = re.search(r"\bprimary\s+key\b[^(]*\(([^)]*)\)", part, re.IGNORECASE)
                keys |= {_name(column.split()[0]) for column in key.group(1).split(",")} if key else set()
                continue
            column = _COLUMN.fullmatch(part)
            if column is None:
                raise ValueError(f"no column in {part!r} of table {table}")
            name, declared = _name(column.group(1)), re.sub(r"\s*([(),])\s*", r"\1", column.group(2).lower())
            declared = _SPELLINGS.get(" ".join(declared.split()), declared)
            required = re.search(r"\bnot\s+null\b|\bprimary\s+key\b", column.group(3), re.IGNORECASE)
            fields.append((name, _data_type(name, declared), required is not None))
        tables[table] = T.StructType([T.StructField(n, t, not (r or n in keys)) for n, t, r in fields])
    return tables


def _name(written: str) -> str:
    return written.strip("\"`[] \n\t").lower()


def _parts(text: str, start: int) -> list[str]:
    """What stands between the commas of a bracket that opens just before ``start``."""
    depth, quote, first, parts = 1, False, start, []
    for at in range(start, len(text)):
        c = text[at]
        quote ^= c == "'"
        if quote:
            continue
        depth += (c == "(") - (c == ")")
        if depth == 0 or depth == 1 and c == ",":
            parts.append(text[first:at].strip())
            first = at + 1
        if depth == 0:
            return [part for part in parts if part]
    raise ValueError(f"a bracket stays open after {text[start:start + 40]!r}")


def landing_schema(contract: T.StructType) -> T.StructType:
    """The types a contract's columns have on disk.

    Dates land as text, and text lands without a length limit. Files do not
    enforce required values, so every column is nullable.
    """

    def landed(field: T.StructField) -> T.StructField:
        text = is_date_column(field.name) or isinstance(field.dataType, T.VarcharType)
        return T.StructField(field.name, T.StringType() if text else field.dataType, True)

    return T.StructType([landed(field) for field in contract.fields])


def text_schema(contract: T.StructType) -> T.StructType:
    """All columns as text, so that malformed numbers can be told from missing ones."""
    return T.StructType([T.StructField(field.name, T.StringType(), True) for field in contract.fields])


def typed(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns read as text with the types they land with; what is malformed becomes NULL."""
    landed = {field.name: field.dataType for field in landing_schema(contract).fields}
    return df.select(
        *[F.col(c).try_cast(landed[c]).alias(c) if c in landed else F.col(c) for c in df.columns]
    )


def _faults(field: T.StructField, found: T.DataType) -> list[tuple[str, Column]]:
    """The rules of one column, and where its value breaks them."""
    value = F.col(field.name)
    rules: list[tuple[str, Column]] = []
    if not field.nullable:
        rules.append(("required", value.isNull()))
    if isinstance(field.dataType, T.VarcharType):
        rules.append(("max_length", F.length(value) > field.dataType.length))
    if is_date_column(field.name) and isinstance(found, T.StringType):
        rules.append(("date_format", rejected_date(field.name)))
    if isinstance(field.dataType, T.NumericType) and isinstance(found, T.StringType):
        rules.append(("number_format", value.isNotNull() & value.try_cast(field.dataType).isNull()))
    return rules


def broken_rules(df: DataFrame, contract: T.StructType, rules: Iterable[str]) -> Column:
    """What each row of ``df`` breaks, as an array of ``column: rule``.

    The rules are those of :func:`check_contract` that look at values, of which
    ``rules`` names the ones that matter.
    """
    wanted = set(rules)
    broken = [
        F.when(fault, F.lit(f"{field.name}: {rule}"))
        for field in contract.fields
        if field.name in df.columns
        for rule, fault in _faults(field, df.schema[field.name].dataType)
        if rule in wanted
    ]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def _holds(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether a column of type ``found`` can carry the values of a contract's column."""
    if isinstance(found, T.StringType) or found == wanted:
        return True
    if isinstance(wanted, T.NumericType):
        return isinstance(found, T.IntegralType) or isinstance(wanted, T.FractionalType) and isinstance(found, T.NumericType)
    days = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(wanted, days) and isinstance(found, days)


def check_contract(df: DataFrame, contract: T.StructType, table: str) -> DataFrame:
    """Count the values of ``df`` that break a table's contract.

    Give the table as landed, so that malformed dates can be told from missing
    ones, and read as text (:func:`text_schema`) for malformed numbers too. One
    aggregate pass covers all rules; the result has one row per rule:
    ``table_name, column_name, rule, violations``, where the rule is
    ``required``, ``max_length``, ``date_format`` or ``number_format``. A
    required column that ``df`` lacks gives a row ``missing_column`` and a
    column of an unfit type a row ``type``, each with one violation; other
    columns that ``df`` lacks are not checked.
    """
    rules: list[tuple[str, str, Column]] = []
    broken_columns: list[tuple[str, str]] = []
    types = {field.name: field.dataType for field in df.schema.fields}
    for field in contract.fields:
        if field.name not in types:
            if not field.nullable:
                broken_columns.append((field.name, "missing_column"))
            continue
        found = types[field.name]
        if not _holds(found, field.dataType):
            broken_columns.append((field.name, "type"))
        rules += [(field.name, rule, fault) for rule, fault in _faults(field, found)]
    if not rules and not broken_columns:
        raise ValueError(f"the contract of {table} has no rule for the given columns")
    counts = df.agg(
        F.lit(1).cast("bigint").alias("broken_column"),
        *[F.count_if(broken).alias(f"rule_{i}") for i, (_, _, broken) in enumerate(rules)],
    )

    def line(column: str, rule: str, violations: str) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.col(violations).alias("violations"),
        )

    lines = [line(column, rule, f"rule_{i}") for i, (column, rule, _) in enumerate(rules)]
    lines += [line(column, rule, "broken_column") for column, rule in broken_columns]
    return counts.select(F.inline(F.array(*lines)))
