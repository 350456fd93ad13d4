from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan_of, rows
from starloom.operators.checks import Reference, Unique, constraint_report
from starloom.operators.partitions import (
    boundaries_between,
    boundary_keys,
    partition_report,
    partition_report_by_month,
)
from starloom.session import new_path
from starloom.sources.footers import NotInFootersError, date_ranges, from_footers, month_counts
from starloom.sources.sinks import write_partitioned


@pytest.fixture(scope="module")
def stored(spark):
    day = F.date_add(F.lit(date(2024, 11, 20)), (F.col("id") % 100).cast("int"))
    key = F.date_format(day, "yyyyMMdd").cast("int")
    fact = spark.range(500).select(F.col("id").alias("booking_id"), day.alias("day"), key.alias("travel_date_key"))
    path = write_partitioned(fact, new_path(spark, "fact"), "travel_date_key", ["booking_id"])
    return path, T.StructType([*fact.schema, T.StructField("travel_month", T.IntegerType())])


def test_reports_from_footers_equal_those_from_rows(spark, stored):
    path, schema = stored
    whole = spark.read.schema(schema).parquet(path)
    first, last = date_ranges(spark, path, schema, "day").first()
    assert (first, last) == whole.agg(F.min("day"), F.max("day")).first()
    boundaries = boundaries_between(first, last)
    assert boundaries == boundary_keys(whole, "day")
    by_month = partition_report_by_month(month_counts(spark, path, schema), boundaries)
    assert rows(by_month) == rows(partition_report(whole, "travel_date_key", boundaries))
    with pytest.raises(ValueError, match="20241115"):
        partition_report_by_month(by_month, [20241115])


def test_what_the_footers_do_not_hold_is_refused(spark, stored):
    before = spark.conf.get("spark.sql.sources.useV1SourceList", None)
    with pytest.raises(NotInFootersError):
        from_footers(spark, *stored, lambda df: df.groupBy("travel_month").agg(F.sum("booking_id")))
    assert spark.conf.get("spark.sql.sources.useV1SourceList", None) == before


def test_an_empty_folder_has_no_range(spark):
    path, schema = new_path(spark, "none"), "day date, n int"
    spark.createDataFrame([], schema).write.parquet(path)
    assert date_ranges(spark, path, T.StructType.fromDDL(schema), "day").first()["lo_day"] is None


def test_all_keys_share_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 7, True), (1, "b", 8, False), (2, "a", None, True), (2, "a", 9, True)], "k int, c string, p int, on boolean")
    parent = spark.createDataFrame([(7,), (8,), (8,), (None,)], "p int")
    report = constraint_report(
        df,
        [
            Unique("k", ("k",)),
            Unique("k and c", ("k", "c")),
            Unique("k where on", ("k",), F.col("on")),
            Unique("p", ("p",)),
            Reference("p exists", "p", parent, "p"),
        ],
    )
    plan = plan_of(report)
    assert dict(rows(report)) == {"k": 2, "k and c": 1, "k where on": 1, "p": 0, "p exists": 1}
    # entries of the keys, the parent's distinct values, the final count
    assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("Exchange SinglePartition") <= 1
    assert constraint_report(df.limit(0), [Unique("k", ("k",))]).first()["violations"] == 0
