"""Date columns as they land on disk, and day arithmetic on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The naming rule and the format of landed dates.
DATE_SUFFIX = "_date"
LANDING_DATE_FORMAT = "yyyyMMdd"


def is_date_column(name: str) -> bool:
    return name.endswith(DATE_SUFFIX)


def landing_date(column: Column | str) -> Column:
    """A landed ``yyyyMMdd`` value as a date; a malformed value gives NULL."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.try_to_date(text, LANDING_DATE_FORMAT)


def rejected_date(column: Column | str) -> Column:
    """True where a landed value is present but is not a date."""
    value = F.col(column) if isinstance(column, str) else column
    return value.isNotNull() & landing_date(value).isNull()


def cast_date_columns(df: DataFrame) -> DataFrame:
    """Turn every ``*_date`` column into a date; other columns stay as they are.

    Column order and names are kept. A column that already is a date or a
    timestamp is cast directly, since it has no landing text to parse.
    """

    def cast(field: T.StructField) -> Column:
        if not is_date_column(field.name):
            return F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("date").alias(field.name)
        return landing_date(field.name).alias(field.name)

    return df.select([cast(field) for field in df.schema.fields])


def day_number(column: Column | str) -> Column:
    """Days since 1970-01-01, so that day arithmetic is integer arithmetic."""
    return F.unix_date(column)
