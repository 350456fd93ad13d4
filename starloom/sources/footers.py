"""Counts and ranges from Parquet footers, without reading a row.

Row counts, smallest and largest values of numbers and dates, over a whole folder or by
its partition columns, are answered from what the files' footers hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.operators.partitions import MONTH

# the reader that can push aggregates down is the newer one
_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


class NotInFootersError(ValueError):
    """An aggregate that the footers do not answer."""


def from_footers(
    spark: SparkSession, path: str, schema: T.StructType, aggregate: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``aggregate`` of the files under ``path``, or an error if it needed their rows.

    One row, or one for each partition value, comes to the driver.
    """
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    try:
        for name, value in _SETTINGS.items():
            spark.conf.set(name, value)
        found = aggregate(spark.read.schema(schema).parquet(path))
        plan = found._jdf.queryExecution().toString()
        if "PushedAggregation: [" not in plan or "PushedAggregation: []" in plan:
            raise NotInFootersError(f"{path}: the footers do not hold this aggregate")
        rows = found.collect()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return spark.createDataFrame(rows, found.schema)


def month_counts(spark: SparkSession, path: str, schema: T.StructType, month: str = MONTH) -> DataFrame:
    """Rows per month folder."""
    return from_footers(spark, path, schema, lambda df: df.groupBy(month).agg(F.count(F.lit(1)).alias("rows")))


def date_ranges(spark: SparkSession, path: str, schema: T.StructType, *days: str) -> DataFrame:
    """Earliest and latest value per date column, as one row."""
    ends = [f(d).alias(f"{n}_{d}") for d in days for n, f in (("lo", F.min), ("hi", F.max))]
    return from_footers(spark, path, schema, lambda df: df.agg(*ends))
