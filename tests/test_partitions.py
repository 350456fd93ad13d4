from bisect import bisect_right
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from starloom.functions.dates import date_key
from starloom.operators.partitions import (
    boundary_keys,
    month_boundaries,
    month_range,
    partition_report,
    partitions_read,
    pruned_range,
    range_partition,
    range_total,
)
from starloom.session import new_path
from starloom.sources.sinks import write_partitioned

# The first days of 16 months.
BOUNDARIES = [
    20250101, 20250201, 20250301, 20250401, 20250501, 20250601, 20250701, 20250801,
    20250901, 20251001, 20251101, 20251201, 20260101, 20260201, 20260301, 20260401,
]


@pytest.fixture(scope="module")
def sales(spark):
    """Bookings over 455 days, a third of all of them in June 2025."""
    start = date(2025, 1, 1)
    day = F.date_add(F.lit(start), (F.col("id") % 455).cast("int"))
    june = F.date_add(F.lit(date(2025, 6, 1)), (F.col("id") % 30).cast("int"))
    travel = F.when(F.col("id") % 3 == 0, june).otherwise(day)
    return spark.range(0, 9000, numPartitions=6).select(
        F.col("id").alias("booking_id"),
        travel.alias("travel_date"),
        date_key(travel).alias("travel_date_key"),
        (F.col("id") % 100).cast("decimal(18,2)").alias("fare_amount"),
        F.when(F.col("id") % 2 == 0, "Confirmed").otherwise("Cancelled").alias("booking_status"),
    )


@pytest.fixture(scope="module")
def stored(spark, sales):
    path = write_partitioned(sales, new_path(spark, "sales"), "travel_date_key", ["booking_id"])
    schema = T.StructType([*sales.schema, T.StructField("travel_month", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def scanned(df):
    """Partitions and files the scan of ``df`` read, by its own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    leaves = plan.collectLeaves()
    metrics = leaves.apply(0)
    while not metrics.metrics().contains("numFiles"):
        metrics = metrics.plan().collectLeaves().apply(0)
    found = metrics.metrics()
    return found.apply("numPartitions").value(), found.apply("numFiles").value()


def test_boundaries_run_from_the_first_month_to_one_past_the_last(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2026, 3, 31),)], "d date")
    assert boundary_keys(df, "d") == BOUNDARIES
    assert rows(month_boundaries(df, "d"))[0] == (1, 20250101)


def test_a_boundary_belongs_to_the_partition_it_opens(spark):
    keys = [k + step for k in BOUNDARIES for step in (-1, 0, 1)] + [0, 99991231]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = df.select("k", range_partition(F.col("k"), BOUNDARIES).alias("n")).collect()
    assert all(r.n == bisect_right(BOUNDARIES, r.k) + 1 for r in got)
    assert max(r.n for r in got) == 17
    null = spark.createDataFrame([(None,)], "k int").select(range_partition(F.col("k"), BOUNDARIES))
    assert null.first()[0] == 1


def test_report_shows_empty_partitions_and_exclusive_ends(spark, sales):
    report = partition_report(sales, "travel_date_key", BOUNDARIES).collect()
    assert [r.partition_number for r in report] == list(range(1, 18))
    assert [r.upper_boundary_key for r in report] == [*BOUNDARIES, None]
    assert report[0].rows == 0 and report[16].rows == 0
    assert sum(r.rows for r in report) == 9000


def test_the_stored_fact_has_the_same_rows_in_one_folder_per_month(spark, sales, stored):
    assert rows(stored.drop("travel_month")) == rows(sales)
    assert stored.where("travel_month <> floor(travel_date_key / 100)").count() == 0
    assert stored.select("travel_month").distinct().count() == 15


def test_a_large_month_is_split_over_tasks(spark, sales, settings):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
    )
    path = write_partitioned(sales, new_path(spark, "split"), "travel_date_key", ["booking_id"])
    june = spark.read.parquet(path).where("travel_month = 202506")
    assert june.select("_metadata.file_path").distinct().count() > 1
    assert spark.read.parquet(path).count() == 9000


def test_a_large_month_is_split_without_adaptive_execution(spark, sales, settings):
    settings(spark__sql__adaptive__enabled="false")
    path = write_partitioned(sales, new_path(spark, "ranges"), "travel_date_key", ["booking_id"])
    june = spark.read.parquet(path).where("travel_month = 202506")
    assert june.select("_metadata.file_path").distinct().count() > 1
    assert spark.read.parquet(path).count() == 9000


def test_month_query_reads_one_partition(stored):
    june = range_total(pruned_range(stored, 20250601, 20250701), "fare_amount")
    assert scanned(june)[0] == 1
    unpruned = range_total(
        stored.where("travel_date_key >= 20250601 and travel_date_key < 20250701"), "fare_amount"
    )
    assert rows(june) == rows(unpruned)
    assert scanned(unpruned)[0] == 15


def test_query_on_other_columns_reads_every_partition(stored):
    assert scanned(range_total(stored.where("booking_status = 'Confirmed'"), "fare_amount"))[0] == 15


@pytest.mark.parametrize(
    "low, high, months",
    [
        (20250601, 20250701, [202506]),
        (20250601, 20250702, [202506, 202507]),
        (20250615, 20250620, [202506]),
        (20251215, 20260101, [202512]),
        (20251201, 20260102, [202512, 202601]),
        (20250601, 20250601, []),
    ],
)
def test_months_of_a_range(spark, low, high, months):
    df = spark.createDataFrame([(m,) for m in (202505, 202506, 202507, 202512, 202601)], "travel_month int")
    assert rows(df.where(month_range(low, high))) == [(m,) for m in months]


@pytest.mark.parametrize("days", [(0, 30), (17, 3), (40, 200)])
def test_pruned_rows_are_the_rows_of_the_range(sales, stored, days):
    first = date(2025, 2, 1) + timedelta(days[0])
    last = first + timedelta(days[1])
    low, high = (int(d.strftime("%Y%m%d")) for d in (first, last))
    expected = sales.where((F.col("travel_date_key") >= low) & (F.col("travel_date_key") < high))
    assert rows(pruned_range(stored, low, high).drop("travel_month")) == rows(expected)


def test_pruning_report_agrees_with_the_scan(stored):
    got = rows(partitions_read(stored, "june", month_range(20250601, 20250701)))
    assert got == [("june", 1, 15)]
    assert rows(partitions_read(stored, "all")) == [("all", 15, 15)]
