from dataclasses import replace
from datetime import date
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starloom.operators.contract import Contract, ForeignKey, expected_days, freshness
from starloom.operators.partitions import pruned_range
from starloom.operators.profile import batch_profile
from starloom.plans.refresh import (
    Layers,
    RefreshStopped,
    accept,
    gate_batch,
    gate_freshness,
    rebuild_fact,
    refresh,
    refresh_dimension,
)
from starloom.plans.warehouse import AIRCRAFT, AIRPORT, BOOKING_CONTRACT, FLIGHT, PASSENGER, TICKET_SALES
from test_dims import AIRPORTS, FLAT

CONTRACT = Contract(
    columns=tuple(replace(c, allowed=None) for c in BOOKING_CONTRACT.columns),
    unique=("booking_id",),
    references=(
        ForeignKey("passenger_id", "passenger", "passenger_id"),
        ForeignKey("flight_id", "flight", "flight_id"),
    ),
    row_rules=BOOKING_CONTRACT.row_rules,
)
YEAR = (date(2025, 1, 1), date(2025, 12, 31))


@pytest.fixture
def layers():
    tag = uuid4().hex[:6]
    return Layers(f"bronze_{tag}", f"silver_{tag}", f"gold_{tag}")


def day_of_feeds(spark, bookings=400, passengers=30):
    first = F.lit(date(2025, 1, 1))
    codes = F.array(*[F.lit(a[0]) for a in AIRPORTS])
    return {
        "airport": spark.createDataFrame(AIRPORTS, FLAT),
        "aircraft": spark.createDataFrame(
            [("AC01", "A320neo", "Airbus", 180)],
            "aircraft_code string, model string, manufacturer string, seat_capacity long",
        ),
        "passenger": spark.range(100 - passengers, 100).select(
            F.col("id").alias("passenger_id"),
            F.concat(F.lit("P"), "id").alias("passenger_name"),
            F.element_at(codes, (F.col("id") % 4 + 1).cast("int")).alias("home_airport_code"),
            F.lit("Blue").alias("frequent_flyer_tier"),
            first.alias("signup_date"),
        ),
        "flight": spark.range(20).select(
            F.col("id").alias("flight_id"),
            F.concat(F.lit("F"), "id").alias("flight_number"),
            F.lit("DEL").alias("origin_airport_code"),
            F.lit("CDG").alias("dest_airport_code"),
            F.lit("AC01").alias("aircraft_code"),
            first.alias("flight_date"),
        ),
        "bookings": spark.range(bookings).select(
            F.col("id").alias("booking_id"),
            (70 + F.col("id") % 31).alias("passenger_id"),
            (F.col("id") % 20).alias("flight_id"),
            first.alias("booking_date"),
            F.date_add(first, (F.col("id") % 120).cast("int")).alias("travel_date"),
            F.lit("Economy").alias("fare_class"),
            F.lit(100).cast("decimal(18,2)").alias("fare_amount"),
            F.lit(10).cast("decimal(18,2)").alias("tax_amount"),
            F.lit("Confirmed").alias("booking_status"),
            F.lit(300).cast("long").alias("miles_earned"),
        ),
    }


def run(spark, layers, feeds):
    dims = [AIRPORT, AIRCRAFT, PASSENGER, FLIGHT]
    return refresh(spark, layers, feeds, CONTRACT, dims, TICKET_SALES, YEAR, on_time(spark, feeds))


def on_time(spark, feeds):
    """A report that all feeds of a day landed at five."""
    day, names = date(2025, 6, 1), spark.createDataFrame([(n,) for n in feeds], "feed string")
    arrivals = names.select(
        "feed", F.lit(day).alias("business_date"), F.lit("2025-06-01 05:00:00").cast("timestamp_ntz").alias("landed_at")
    )
    return freshness(arrivals, expected_days(names, day, day)), day


def test_days_one_after_another(spark, layers):
    fact = run(spark, layers, day_of_feeds(spark))
    unknown = spark.range(400).where("70 + id % 31 = 100").count()
    assert fact.count() == 400 - unknown
    assert spark.table(f"{layers.bronze}.bookings").count() == 400
    assert rows(spark.table(f"{layers.bronze}.bookings_alerts")) == [
        ("passenger_id not in passenger", unknown)
    ]
    keys = rows(spark.table(f"{layers.silver}.dim_passenger"), "passenger_id", "passenger_key")

    again = run(spark, layers, day_of_feeds(spark, bookings=450, passengers=40))
    later = dict(rows(spark.table(f"{layers.silver}.dim_passenger"), "passenger_id", "passenger_key"))
    assert len(later) == 40 and all(later[i] == k for i, k in keys)
    assert again.count() > fact.count() - 1
    assert spark.table(f"{layers.gold}.rejects_ticket_sales").count() == 0

    march = pruned_range(again, 20250301, 20250401)
    assert march.count() == again.where("travel_date_key between 20250301 and 20250331").count() > 0
    assert "isnotnull(travel_month" in plan_of(march).split("PartitionFilters: [")[1].split("]")[0]

    # a snapshot that shrinks stops the day
    with pytest.raises(RefreshStopped, match="450 rows, now 390"):
        run(spark, layers, day_of_feeds(spark, bookings=390, passengers=40))
    assert spark.table(f"{layers.bronze}.bookings").count() == 450
    # so does an empty one, and any other feed that shrinks or changes its columns
    with pytest.raises(RefreshStopped, match="bookings: 450 rows, now 0"):
        run(spark, layers, day_of_feeds(spark, bookings=0, passengers=40))
    with pytest.raises(RefreshStopped, match="passenger: 40 rows, now 30"):
        run(spark, layers, day_of_feeds(spark, bookings=450, passengers=30))
    feeds = day_of_feeds(spark, bookings=450, passengers=40)
    feeds["flight"] = feeds["flight"].withColumn("flight_id", F.col("flight_id").cast("string"))
    with pytest.raises(RefreshStopped, match="flight: column retyped flight_id"):
        run(spark, layers, feeds)
    assert spark.table(f"{layers.gold}.fact_ticket_sales").count() == again.count()

    # a fact that gained rows on the way is not shown
    shown = again.count()
    dims = {d: spark.table(f"{layers.silver}.dim_{d}") for d in ("date", "flight", "passenger")}
    dims["passenger"] = dims["passenger"].unionByName(dims["passenger"])
    bookings = spark.table(f"{layers.bronze}.bookings")
    with pytest.raises(RefreshStopped, match="rows missing"):
        rebuild_fact(spark, layers, bookings, TICKET_SALES, dims)
    assert spark.table(f"{layers.gold}.fact_ticket_sales").count() == shown


def test_a_late_feed_stops_the_day(spark):
    arrivals = spark.sql(
        "select 'bookings' feed, date '2025-06-01' business_date, timestamp_ntz '2025-06-01 05:00:00' landed_at "
        "union all select 'bookings', date '2025-06-02', timestamp_ntz '2025-06-02 09:00:00'"
    )
    report = freshness(arrivals, expected_days(arrivals, date(2025, 6, 1), date(2025, 6, 3)))
    gate_freshness(report, date(2025, 6, 1))
    with pytest.raises(RefreshStopped, match="1 feeds not delivered"):
        gate_freshness(report, date(2025, 6, 3))
    with pytest.raises(RefreshStopped, match="nothing is known"):
        gate_freshness(report, date(2025, 6, 4))
    with pytest.raises(RefreshStopped, match="bookings"):
        gate_freshness(report, date(2025, 6, 2))


def test_departed_members_keep_their_keys(spark, layers):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layers.silver}")
    airports = refresh_dimension(spark, layers, spark.createDataFrame(AIRPORTS, FLAT), AIRPORT, {})
    dims, feeds = {"airport": airports}, day_of_feeds(spark)["passenger"]
    first = refresh_dimension(spark, layers, feeds.where("passenger_id <> 99"), PASSENGER, dims)
    last = first.where("passenger_id = 98").first()["passenger_key"]
    refresh_dimension(spark, layers, feeds.where("passenger_id < 98"), PASSENGER, dims)
    third = refresh_dimension(spark, layers, feeds, PASSENGER, dims)
    assert third.where("passenger_id = 98").first()["passenger_key"] == last
    assert third.where("passenger_id = 99").first()["passenger_key"] > last


def test_a_passenger_without_airport_is_a_reject(spark, layers):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layers.silver}")
    airports = refresh_dimension(spark, layers, spark.createDataFrame(AIRPORTS, FLAT), AIRPORT, {})
    lost = F.when(F.col("passenger_id") == 80, "XXX").otherwise(F.col("home_airport_code"))
    feed = day_of_feeds(spark)["passenger"].withColumn("home_airport_code", lost)
    kept = refresh_dimension(spark, layers, feed, PASSENGER, {"airport": airports})
    assert kept.count() == 29
    assert rows(spark.table(f"{layers.silver}.rejects_passenger")) == [(80, ["no home airport"])]


def test_a_batch_that_changed_its_columns_stops_the_day(spark):
    bookings = day_of_feeds(spark)["bookings"]

    def gate(batch, before=None):
        gate_batch("bookings", batch_profile(batch, CONTRACT), before and batch_profile(before, CONTRACT), CONTRACT)

    gate(bookings)
    with pytest.raises(RefreshStopped, match="no column booking_status"):
        gate(bookings.drop("booking_status"))
    with pytest.raises(RefreshStopped, match="column retyped fare_amount"):
        gate(bookings.withColumn("fare_amount", F.col("fare_amount").cast("double")), bookings)
    with pytest.raises(RefreshStopped, match="column removed note"):
        gate(bookings, bookings.withColumn("note", F.lit(None).cast("string")))
    gate(bookings.withColumn("note", F.lit(None).cast("string")), bookings)
    with pytest.raises(RefreshStopped, match="0 rows, now 0"):
        gate(bookings.limit(0))


def test_a_batch_that_was_turned_down_is_nothing_to_compare_with(spark, layers):
    run(spark, layers, day_of_feeds(spark))
    dims, smaller = [AIRPORT, AIRCRAFT, PASSENGER, FLIGHT], day_of_feeds(spark, bookings=398)
    with pytest.raises(RefreshStopped, match="breaks its contract"):
        refresh(spark, layers, smaller, CONTRACT, dims, TICKET_SALES, YEAR, on_time(spark, smaller), "reject")
    # one per cent less than the batch turned down, but more than that below the accepted one
    with pytest.raises(RefreshStopped, match="400 rows, now 395"):
        run(spark, layers, day_of_feeds(spark, bookings=395))


def test_a_batch_may_be_rejected_whole(spark, layers):
    feeds = day_of_feeds(spark)
    parents = {name: feeds[name] for name in ("passenger", "flight")}
    with pytest.raises(RefreshStopped, match="breaks its contract"):
        accept(layers, "bookings", feeds["bookings"], CONTRACT, parents, "reject")
    assert spark.table(f"{layers.bronze}.bookings_quarantine").count() == 400
    good = feeds["bookings"].where("passenger_id < 100")
    assert accept(layers, "bookings", good, CONTRACT, parents, "reject").count() == good.count()
