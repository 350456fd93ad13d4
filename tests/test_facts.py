from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starloom.model import History
from starloom.operators.dims import calendar_dim
from starloom.operators.facts import asof_lookup, load_fact, load_fact_asof
from starloom.plans.warehouse import TICKET_SALES

DAY = date(2025, 6, 1)
SPEC = History()
BOOKING = (
    "booking_id long, passenger_id long, flight_id long, booking_date date, travel_date date, "
    "fare_class string, fare_amount decimal(18,2), tax_amount decimal(18,2), "
    "booking_status string, miles_earned long"
)


def booking(spark, *given):
    filled = [
        (b, p, f, booked, DAY + timedelta(3), "Economy", 100, 10, "Confirmed", miles)
        for b, p, f, booked, miles in given
    ]
    df = spark.createDataFrame(
        [(*r[:6], str(r[6]), str(r[7]), *r[8:]) for r in filled],
        BOOKING.replace("decimal(18,2)", "string"),
    )
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("fare_amount", "tax_amount")})


@pytest.fixture
def dims(spark):
    return {
        "date": calendar_dim(spark, date(2025, 1, 1), date(2025, 12, 31)),
        "passenger": spark.createDataFrame([(70, 1), (71, 2)], "passenger_id long, passenger_key long"),
        "flight": spark.createDataFrame([(5, 50), (6, 60)], "flight_id long, flight_key long"),
    }


def test_every_row_is_loaded_or_rejected_with_its_reasons(spark, dims):
    src = booking(
        spark,
        (1, 70, 5, DAY, 300),
        (2, 99, 5, DAY, 300),
        (3, 71, None, DAY, 300),
        (4, 98, 7, date(2020, 1, 1), 300),
    )
    fact, rejects = load_fact(src, TICKET_SALES, dims)
    assert rows(fact, "booking_id", "booking_date_key", "travel_date_key", "passenger_key", "flight_key") == [
        (1, 20250601, 20250604, 1, 50)
    ]
    assert rows(rejects) == [
        (2, ["no passenger"]),
        (3, ["no flight"]),
        (4, ["no booking date", "no passenger", "no flight"]),
    ]


def test_the_same_load_without_broadcast(spark, dims, no_broadcast):
    src = booking(spark, *[(i, 70 if i % 3 else 71, 5 + i % 3, DAY, i) for i in range(60)])
    fact, rejects = load_fact(src, TICKET_SALES, dims)
    assert fact.count() == 40
    assert rows(rejects, "booking_id") == rows(spark.range(60).where("id % 3 = 2"))


def test_miles_too_large_for_the_fact_fail_the_load(spark, dims):
    fact, _ = load_fact(booking(spark, (1, 70, 5, DAY, 2**31)), TICKET_SALES, dims)
    with pytest.raises(Exception, match="does not fit INT"):
        fact.collect()


def versions(spark, *given):
    """(key, id, from, to) rows."""
    return spark.createDataFrame(
        list(given), "passenger_key long, passenger_id long, effective_from date, effective_to date"
    )


def test_validity_includes_its_first_day_and_not_its_last(spark):
    dim = versions(
        spark, (1, 70, date(2025, 1, 1), DAY), (2, 70, DAY, date(9999, 12, 31))
    )
    days = [date(2024, 12, 31), date(2025, 1, 1), DAY - timedelta(1), DAY, DAY + timedelta(400)]
    src = spark.createDataFrame([(70, d) for d in days], "passenger_id long, booking_date date")
    got = asof_lookup(
        src, dim, SPEC, {"passenger_id": "passenger_id"}, "booking_date", {"passenger_key": "k"}
    )
    assert [r.k for r in got.orderBy("booking_date").collect()] == [None, 1, 1, 2, 2]


def test_versions_are_split_by_year_only_where_a_key_has_many(spark, settings):
    """Before, each version was listed once per year it covers and Spark could broadcast that list."""
    settings(spark__starloom__broadcastBytes=0)  # files may look small to Spark all the same
    dim = versions(spark, (1, 70, date(2000, 1, 1), DAY), (2, 70, DAY, date(9999, 12, 31)))
    src = spark.createDataFrame([(70, DAY), (70, date(1999, 1, 1))], "passenger_id long, booking_date date")
    on, take = {"passenger_id": "passenger_id"}, {"passenger_key": "k"}
    whole = asof_lookup(src, dim, SPEC, on, "booking_date", take)
    assert "Generate" not in plan_of(whole) and "BroadcastHashJoin" not in plan_of(whole)
    settings(spark__starloom__versionsPerKey=1)
    split = asof_lookup(src, dim, SPEC, on, "booking_date", take)
    assert "Generate" in plan_of(split) and "BroadcastHashJoin" not in plan_of(split)
    assert rows(whole, "booking_date", "k") == rows(split, "booking_date", "k")
    assert rows(whole, "k") == [(2,), (None,)]


@pytest.mark.parametrize("spread", [False, True])
def test_years_give_what_the_plain_interval_join_gives(spark, request, spread):
    if spread:
        request.getfixturevalue("no_broadcast")
    start = date(2024, 1, 1)
    spans = [(start + timedelta(5 * i), start + timedelta(5 * i + 5)) for i in range(80)]
    dim = versions(
        spark,
        *[(100 * p + i, p, a, b) for p in (1, 2) for i, (a, b) in enumerate(spans) if (i + p) % 7],
    )
    src = spark.range(0, 1500, numPartitions=4).select(
        "id",
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 4).cast("long").alias("passenger_id"),
        F.date_add(F.lit(start), (F.col("id") % 450 - 20).cast("int")).alias("booking_date"),
    )
    on = {"passenger_id": "passenger_id"}
    plain = asof_lookup(src, dim, SPEC, on, "booking_date", {"passenger_key": "k"})
    assert "__year" not in plain.columns
    within = "booking_date >= effective_from AND booking_date < effective_to"
    kept = dim.withColumnRenamed("passenger_id", "p").withColumnRenamed("passenger_key", "k")
    simple = src.join(kept, F.expr(f"p = passenger_id AND {within}"), "left")
    assert rows(plain, "id", "k") == rows(simple, "id", "k")
    assert plain.count() == 1500


def test_asof_join_is_keyed(spark, no_broadcast):
    dim = versions(spark, (1, 70, DAY, date(9999, 12, 31)))
    src = spark.createDataFrame([(70, DAY)], "passenger_id long, booking_date date")
    got = asof_lookup(src, dim, SPEC, {"passenger_id": "passenger_id"}, "booking_date", {"passenger_key": "k"})
    plan = plan_of(got)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_fact_load_as_of_the_booking_date(spark, dims):
    dims = {
        **dims,
        "passenger": versions(
            spark, (1, 70, date(2025, 1, 1), DAY), (9, 70, DAY, date(9999, 12, 31))
        ),
    }
    src = booking(
        spark,
        (1, 70, 5, DAY - timedelta(1), 1),
        (2, 70, 5, DAY, 1),
        (3, 70, 5, date(2024, 1, 1), 1),
    )
    fact, rejects = load_fact_asof(src, TICKET_SALES, dims, {"passenger": (SPEC, "booking_date")})
    assert rows(fact, "booking_id", "passenger_key") == [(1, 1), (2, 9)]
    assert rows(rejects) == [(3, ["no booking date", "no passenger"])]


def test_asof_lookup_by_a_composite_key_and_without_source_rows(spark):
    dim = versions(spark, (1, 70, DAY, date(9999, 12, 31))).withColumn("region", F.lit("x"))
    src = spark.createDataFrame(
        [(70, "x", DAY), (70, "y", DAY)], "passenger_id long, region string, booking_date date"
    )
    on = {"passenger_id": "passenger_id", "region": "region"}
    got = asof_lookup(src, dim, SPEC, on, "booking_date", {"passenger_key": "k"})
    assert rows(got, "region", "k") == [("x", 1), ("y", None)]
    none = src.where("false")
    assert asof_lookup(none, dim, SPEC, on, "booking_date", {"passenger_key": "k"}).count() == 0
