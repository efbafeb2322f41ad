"""Writing datasets, in versions of which one is current."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from onsetlab.sources import versions
from onsetlab.sources.staging import remove_folders


class IncompleteWrite(RuntimeError):
    """A version holds other rows than were written; the old one stays current."""


def write_dataset(
    df: DataFrame,
    path: str,
    table: str | None = None,
    compression: str = "none",
    even: bool = False,
    keep: int = 1,
) -> None:
    """Replace the Parquet dataset at ``path``, and its catalog table if named.

    The rows go to a new folder below ``path``. Only when all are there, and
    as many as were given, the catalog's table is moved to it and the version is
    entered as the current one; until then, and if anything fails, the old rows
    stay what is read. ``keep`` older versions are left for those who still read
    them.

    The table is external: columns that are new are added to its catalog entry,
    and if columns go or change their type it is entered anew. Files get an even
    size, whatever the partitioning of ``df``; say ``even`` if its partitions are
    of a size already.
    """
    spark = df.sparkSession
    folder = versions.new_folder(path)
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if not even:
        rows = rows.hint("rebalance")
    try:
        rows.write.format("parquet").option("compression", compression).save(folder)
        there = spark.read.schema(df.schema).parquet(folder).count()
        if there != seen.get["rows"]:
            raise IncompleteWrite(f"{folder} has {there} rows of {seen.get['rows']}")
        if table is not None:
            _switch_table(df, folder, table)
    except BaseException:
        if table is None or _location(spark, table) != versions.qualified(spark, folder):
            remove_folders(spark, [folder])
        raise
    versions.commit(spark, path, folder, {"rows": there}, keep)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a dataset, or plain Parquet files at ``path``."""
    return spark.read.parquet(versions.current_folder(spark, path) or path)


def _location(spark: SparkSession, table: str) -> str | None:
    try:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    except AnalysisException:
        return None
    return next((r["data_type"].rstrip("/") for r in described if r["col_name"] == "Location"), None)


def _switch_table(df: DataFrame, folder: str, table: str) -> None:
    spark, wanted = df.sparkSession, dict(df.dtypes)
    known = dict(spark.table(table).dtypes) if spark.catalog.tableExists(table) else None
    if known is not None and any(wanted.get(name) != kind for name, kind in known.items()):
        spark.sql(f"DROP TABLE {table}")
        known = None
    if known is None:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
        return
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
