"""How many bytes rows take in memory, for tables that may be copied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_OVERHEAD_BYTES = 32


def row_bytes(table: DataFrame) -> Column:
    """An estimate from above of the bytes of a row of numbers, dates and texts."""
    texts = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    size = F.lit(ROW_OVERHEAD_BYTES + 8 * (len(table.columns) - len(texts))).cast("bigint")
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return size


def table_bytes(table: DataFrame) -> Column:
    return F.coalesce(F.sum(row_bytes(table)), F.lit(0))
