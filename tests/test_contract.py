from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.contract import (
    Contract,
    ContractColumn,
    ForeignKey,
    apply_contract,
    arrivals_of,
    check_references,
    check_types,
    check_unique,
    classify_drift,
    expected_days,
    freshness,
    local_time,
    named_columns,
    new_values,
    volume_by_day,
    volume_check,
)
from starloom.session import new_path

CONTRACT = Contract(
    columns=(
        ContractColumn("booking_id", "bigint"),
        ContractColumn("passenger_id", "bigint"),
        ContractColumn("booking_date", "date"),
        ContractColumn("travel_date", "date"),
        ContractColumn("fare_amount", "decimal(18,2)", minimum=0),
        ContractColumn("booking_status", "string", allowed=("Confirmed", "Cancelled", "NoShow")),
    ),
    unique=("booking_id",),
    references=(ForeignKey("passenger_id", "passengers", "passenger_id"),),
    row_rules={"booked after travel": "booking_date > travel_date"},
)
SCHEMA = (
    "booking_id long, passenger_id long, booking_date date, travel_date date, "
    "fare_amount double, booking_status string"
)
D = date(2025, 6, 1)
GOOD = (1, 70, D, D, 10.0, "Confirmed")


@pytest.fixture
def passengers(spark):
    return spark.createDataFrame([(70,)], "passenger_id long")


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [
            GOOD,
            (2, 99, D, D, 10.0, "Confirmed"),
            (3, 70, date(2025, 7, 1), D, -1.0, "Refunded"),
            (4, 70, D, D, None, "NoShow"),
            (5, 70, D, D, 1.0, "Cancelled"),
            (5, 70, D, D, 1.0, "Cancelled"),
            (None, 70, D, D, 0.0, None),
        ],
        SCHEMA,
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_quarantine_with_reasons(spark, batch, passengers, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    accepted, quarantined, alerts = apply_contract(batch, CONTRACT, {"passengers": passengers})
    assert rows(accepted) == [GOOD]
    assert accepted.columns == batch.columns
    assert rows(quarantined, "booking_id", "reasons") == [
        (2, ["passenger_id not in passengers"]),
        (3, ["booking_status not allowed", "fare_amount below 0", "booked after travel"]),
        (4, ["fare_amount is null"]),
        (5, ["booking_id repeated"]),
        (5, ["booking_id repeated"]),
        (None, ["booking_id is null", "booking_status is null"]),
    ]
    assert dict(rows(alerts))["booking_id repeated"] == 2
    assert accepted.count() + quarantined.count() == batch.count()


def test_reject_sets_the_whole_batch_aside(spark, batch, passengers):
    parents = {"passengers": passengers}
    accepted, quarantined, alerts = apply_contract(batch, CONTRACT, parents, mode="reject")
    assert accepted.count() == 0 and quarantined.count() == batch.count() and alerts.count() == 8
    clean = spark.createDataFrame([GOOD], SCHEMA)
    accepted, quarantined, alerts = apply_contract(clean, CONTRACT, parents, mode="reject")
    assert accepted.count() == 1 and quarantined.count() == 0 and alerts.count() == 0


def test_unknown_mode(spark, batch, passengers):
    with pytest.raises(ValueError):
        apply_contract(batch, CONTRACT, {"passengers": passengers}, mode="ignore")


def test_a_booking_number_delivered_very_often_is_all_set_aside(spark, passengers, no_broadcast):
    many = spark.range(0, 600, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1000).cast("long").alias("booking_id"),
        F.lit(70).cast("long").alias("passenger_id"),
        F.lit(D).alias("booking_date"),
        F.lit(D).alias("travel_date"),
        F.lit(1.0).alias("fare_amount"),
        F.lit("Confirmed").alias("booking_status"),
    )
    accepted, quarantined, _ = apply_contract(many, CONTRACT, {"passengers": passengers})
    assert (accepted.count(), quarantined.count()) == (400, 200)


def test_types_missing_and_extra_columns(spark):
    raw = spark.createDataFrame(
        [("1", "x", "2025-06-01", "12.50", "Confirmed"), ("9" * 30, None, "2025-13-01", "abc", "")],
        "booking_id string, passenger_id string, booking_date string, fare_amount string, extra string",
    )
    got = {r.column_name: (r.declared_type, r.status, r.bad_values) for r in check_types(raw, CONTRACT).collect()}
    assert got == {
        "booking_id": ("bigint", "present", 1),
        "passenger_id": ("bigint", "present", 1),
        "booking_date": ("date", "present", 1),
        "travel_date": ("date", "missing", 0),
        "fare_amount": ("decimal(18,2)", "present", 1),
        "booking_status": ("string", "missing", 0),
        "extra": ("undeclared", "extra", 0),
    }


def test_uniqueness_and_references(spark, batch, passengers):
    assert rows(check_unique(batch, CONTRACT)) == [(5, 2)]
    assert rows(check_references(batch, CONTRACT, {"passengers": passengers})) == [(1,)]


def test_an_extra_column_reaches_nobody(spark, batch):
    wider = batch.withColumn("payment_method", F.lit("card"))
    assert rows(named_columns(wider, CONTRACT)) == rows(named_columns(batch, CONTRACT))


def test_new_values(spark, batch):
    assert rows(new_values(batch, CONTRACT)) == [("booking_status", "Refunded", 1)]


def test_drift(spark, batch):
    same = classify_drift(batch, batch.where("booking_status <> 'Refunded'"), CONTRACT)
    assert same.count() == 0
    new = batch.select(
        "booking_id", "passenger_id", "booking_date", "travel_date",
        F.col("fare_amount").cast("float"), "booking_status", F.lit("card").alias("payment_method"),
        F.lit(None).cast("string").alias("note"),
    )
    got = rows(classify_drift(batch, new, CONTRACT), "change", "column_name", "detail", "breaking", "rows")
    assert got == [
        ("column added", "note", "string", False, None),
        ("column added", "payment_method", "string not null", True, None),
        ("column retyped", "fare_amount", "double to float", True, None),
        ("value added", "booking_status", "Refunded", True, 1),
    ]


def test_a_rename_breaks(spark, batch):
    renamed = batch.withColumnRenamed("booking_status", "status")
    got = classify_drift(batch, renamed, CONTRACT)
    assert rows(got, "change", "column_name", "breaking") == [
        ("column added", "status", False),
        ("column removed", "booking_status", True),
    ]


def test_freshness(spark):
    landed = [
        ("bookings", date(2025, 6, 1), datetime(2025, 6, 1, 6, 0)),
        ("bookings", date(2025, 6, 1), datetime(2025, 6, 1, 9, 0)),
        ("bookings", date(2025, 6, 2), datetime(2025, 6, 2, 8, 0)),
        ("bookings", date(2025, 6, 3), datetime(2025, 6, 3, 8, 0, 1)),
        ("bookings", date(2025, 6, 5), datetime(2025, 6, 4, 23, 0)),
    ]
    arrivals = spark.createDataFrame(landed, "feed string, business_date date, landed_at timestamp_ntz")
    got = freshness(arrivals, expected_days(arrivals, date(2025, 6, 1), date(2025, 6, 6)))
    assert rows(got, "business_date", "status", "paused") == [
        (date(2025, 6, 1), "on_time", False),
        (date(2025, 6, 2), "late", False),
        (date(2025, 6, 3), "pause", True),
        (date(2025, 6, 4), "missing", True),
        (date(2025, 6, 5), "on_time", False),
        (date(2025, 6, 6), "missing", True),
    ]


def test_delivery_times_are_local(spark):
    df = spark.sql("select timestamp '2025-06-01 00:30:00' as t")
    assert df.select(local_time(F.col("t"))).first()[0] == datetime(2025, 6, 1, 6, 0)


def test_arrivals_of_files(spark):
    path = new_path(spark, "files")
    spark.range(3).write.partitionBy().parquet(path)
    files = spark.read.schema("id long").parquet(path)
    got = arrivals_of(files, "bookings", F.current_date())
    assert got.columns == ["feed", "business_date", "landed_at"]
    assert got.where("landed_at is null").count() == 0


@pytest.mark.parametrize(
    "prior, today, status", [(1000, 1000, "ok"), (1000, 1200, "ok"), (1000, 990, "decreased"), (1000, 989, "alert")]
)
def test_volume(spark, prior, today, status):
    assert rows(volume_check(spark.range(today), spark.range(prior))) == [(prior, today, status)]


def test_volume_by_day(spark):
    days = [date(2025, 6, 1)] * 100 + [date(2025, 6, 2)] * 98 + [date(2025, 6, 4)] * 5
    df = spark.createDataFrame([(d,) for d in days], "day date")
    got = volume_by_day(df, "day", date(2025, 6, 1), date(2025, 6, 4))
    assert rows(got, "business_date", "today_rows", "prior_rows", "status") == [
        (date(2025, 6, 1), 100, None, "first"),
        (date(2025, 6, 2), 98, 100, "alert"),
        (date(2025, 6, 3), 0, 98, "missing"),
        (date(2025, 6, 4), 5, 98, "alert"),
    ]
