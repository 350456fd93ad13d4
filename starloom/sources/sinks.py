"""Sinks: every write goes to a new version, and is shown once it is checked.

A table name is a view over the current version's folder. Replacing the view is
one catalog operation, so readers see the old version or the new one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from starloom.functions.dates import month_of
from starloom.session import new_path


class RowCountError(RuntimeError):
    """A written version does not hold the rows it was given."""


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` to an unused path and compare row counts.

    The rows are counted while they are written; reading the count back needs
    the files' footers only.
    """
    spark = df.sparkSession
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("error").partitionBy(*(partition_by or [])).parquet(path)
    given = seen.get["rows"]
    kept = spark.read.schema(df.schema).parquet(path).count()
    if kept != given:
        raise RowCountError(f"{path}: {given} rows given, {kept} kept")
    return path


def publish(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """Make ``path`` the current version of ``table``.

    The view states each column's type, as a folder's name does not hold the type
    of its partition column.
    """
    if "." in table:
        layer = table.rpartition(".")[0]
        if not spark.catalog.databaseExists(layer):
            spark.sql(f"CREATE DATABASE {layer} LOCATION '{new_path(spark, layer)}'")
    columns = ", ".join(
        f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields
    )
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM parquet.`{path}`")
    return spark.table(table)


def replace_table(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Full refresh: write aside, check, swap in.

    ``check`` raises to keep the old version. The frame may read the very table
    it replaces. A text column cannot partition it: a folder named ``007`` would
    be read as the number 7.
    """
    spark = df.sparkSession
    text = [c for c in partition_by or [] if isinstance(df.schema[c].dataType, T.StringType)]
    if text:
        raise ValueError(f"text cannot partition a table: {', '.join(text)}")
    path = write_version(df, new_path(spark, table.replace(".", "-")), partition_by)
    if check is not None:
        check(spark.read.schema(df.schema).parquet(path))
    return publish(spark, table, path, df.schema)


def append(df: DataFrame, path: str, columns: list[str]) -> None:
    """Add rows to a stored table, its columns taken by name."""
    df.select(*columns).write.mode("append").parquet(path)


def by_month(df: DataFrame, key: str, grain: list[str], month: str = "travel_month") -> DataFrame:
    """Rows gathered by month for few files, sorted by key and grain.

    Adaptive execution splits a month too large for one task and merges small ones.
    Without it, ranges of key and grain do the same for one more pass over the rows.
    """
    order = [month, key, *grain]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        placed = df.hint("rebalance", month)
    else:
        placed = df.repartitionByRange(*order)
    return placed.sortWithinPartitions(*order)


def write_partitioned(
    df: DataFrame, path: str, key: str, grain: list[str], month: str = "travel_month"
) -> str:
    """Write a fact in one folder per month of ``key``, sorted by key and grain."""
    rows = df.withColumn(month, month_of(F.col(key)))
    return write_version(by_month(rows, key, grain, month), path, [month])
