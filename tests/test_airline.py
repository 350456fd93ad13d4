"""The whole warehouse from six CSV files of the feeds' published sizes."""

from datetime import date
from decimal import Decimal
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.plans.airline import CONTRACT, FARE_CLASSES, FILES, SCHEMAS, STATUSES, file_arrivals, load, read_feeds
from starloom.plans.refresh import Layers, RefreshStopped
from starloom.plans.warehouse import TICKET_SALES
from starloom.operators.partitions import month_range, partitions_read
from starloom.operators.rollup import rollup
from starloom.sources.facts import FactStore

AS_OF = date(2026, 9, 1)


def pick(values, number):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def feeds(spark):
    n = F.col("id")
    codes = [f"{chr(65 + i)}{chr(65 + i)}X" for i in range(24)]
    countries = [f"Country {i % 13}" for i in range(24)]
    airports = spark.createDataFrame(
        [(c, f"{c} Intl", f"City {c}", k, f"Region {int(k[8:]) % 6}") for c, k in zip(codes, countries)],
        SCHEMAS["airport"],
    )
    aircraft = spark.createDataFrame(
        [(f"AC{i:02}", f"M{i}", "Maker", 150 + i) for i in range(10)], SCHEMAS["aircraft"]
    )
    passengers = spark.range(1500).select(
        (700000 + n).alias("passenger_id"),
        F.concat(F.lit("P"), n).alias("passenger_name"),
        pick(codes, n).alias("home_airport_code"),
        F.lit("Blue").alias("frequent_flyer_tier"),
        F.date_add(F.lit(date(2020, 1, 1)), (n % 900).cast("int")).alias("signup_date"),
    )
    flown = F.date_add(F.lit(date(2025, 1, 1)), (n % 455).cast("int"))
    flights = spark.range(2000).select(
        n.alias("flight_id"),
        F.concat(F.lit("F"), n).alias("flight_number"),
        pick(codes, n).alias("origin_airport_code"),
        pick(codes, n + 5).alias("dest_airport_code"),
        pick([f"AC{i:02}" for i in range(10)], n).alias("aircraft_code"),
        flown.alias("flight_date"),
    )
    travelled = F.date_add(F.lit(date(2025, 1, 1)), (n % 2000 % 455).cast("int"))
    bookings = spark.range(40000).select(
        n.alias("booking_id"),
        (700000 + n % 1500).alias("passenger_id"),
        (n % 2000).alias("flight_id"),
        F.date_sub(travelled, (n % 60).cast("int")).alias("booking_date"),
        travelled.alias("travel_date"),
        pick(FARE_CLASSES, n).alias("fare_class"),
        (n % 1000 + 100).cast("decimal(18,2)").alias("fare_amount"),
        F.lit(10).cast("decimal(18,2)").alias("tax_amount"),
        pick(STATUSES, n).alias("booking_status"),
        F.lit(300).alias("miles_earned"),
    )
    moved = pick(codes, n + F.when(n >= 109, 1).otherwise(0))
    changed = spark.range(200).select(
        (700000 + n).alias("passenger_id"),
        F.concat(F.lit("P"), n).alias("passenger_name"),
        moved.alias("home_airport_code"),
        F.when(n < 191, "Silver").otherwise("Blue").alias("frequent_flyer_tier"),
    )
    new = spark.range(50).select(
        (900000 + n).alias("passenger_id"),
        F.concat(F.lit("N"), n).alias("passenger_name"),
        pick(codes, n).alias("home_airport_code"),
        F.lit("Blue").alias("frequent_flyer_tier"),
    )
    return {
        "airport": airports,
        "aircraft": aircraft,
        "passenger": passengers,
        "flight": flights,
        "bookings": bookings,
        "updates": changed.unionByName(new),
    }


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("feeds")
    for name, df in feeds(spark).items():
        df.write.option("header", True).csv(str(path / FILES[name]))
    return str(path)


@pytest.fixture(scope="module")
def layers():
    tag = uuid4().hex[:6]
    return Layers(f"b_{tag}", f"s_{tag}", f"g_{tag}")


@pytest.fixture(scope="module")
def airline(spark, folder, layers):
    return load(spark, folder, AS_OF, arrived(spark, 5), layers)


def arrived(spark, hour, day=AS_OF):
    landed = F.lit(f"{day} 0{hour}:00:00").cast("timestamp_ntz").alias("landed_at")
    names = spark.createDataFrame([(n,) for n in FILES], "feed string")
    return names.select("feed", F.lit(day).alias("business_date"), landed)


def test_a_day_whose_feeds_are_not_there_is_not_loaded(spark, folder):
    layers = Layers("b_none", "s_none", "g_none")
    with pytest.raises(RefreshStopped, match="6 feeds not delivered in time"):
        load(spark, folder, AS_OF, arrived(spark, 9), layers)
    with pytest.raises(RefreshStopped, match="1 feeds not delivered in time on 2026-09-01: flight"):
        load(spark, folder, AS_OF, arrived(spark, 5).where("feed <> 'flight'"), layers)
    files = file_arrivals(spark, folder, AS_OF).groupBy("feed").count()
    assert {r["feed"] for r in files.collect()} == set(FILES)
    assert not spark.catalog.databaseExists("b_none")


def test_every_feed_is_loaded(airline):
    assert rows(airline.row_counts()) == [
        ("bronze_aircraft", 10),
        ("bronze_airports", 24),
        ("bronze_bookings", 40000),
        ("bronze_flights", 2000),
        ("bronze_passengers", 1500),
        ("stg_passenger_updates", 250),
    ]


def test_the_fact_is_complete_and_has_no_orphans(airline):
    assert rows(airline.reconciliation()) == [(40000, 40000, 0)]
    assert rows(airline.orphans()) == [(0, 0, 0, 0)]
    assert rows(airline.off_schedule()) == [(40000, 0)]
    assert airline.dims["date"].count() == 1096


def test_every_airport_reaches_its_region(airline):
    assert airline.places().count() == 24
    assert airline.geography["country"].count() == 13
    assert airline.geography["country"].select("region").distinct().count() == 6


def test_history(airline):
    assert rows(airline.versions()) == [(1750, 1550)]
    assert airline.not_one_current().count() == 0
    first = airline.versions_of(700000).collect()
    assert [(r.frequent_flyer_tier, r.is_current, r.effective_to) for r in first] == [
        ("Blue", False, AS_OF),
        ("Silver", True, date(9999, 12, 31)),
    ]
    assert airline.versions_of(900000).count() == 1


def test_partitions(airline):
    report = airline.partition_report().collect()
    assert len(report) == 17 and report[0].rows == 0 and report[16].rows == 0
    assert [r.upper_boundary_key for r in report][:2] == [20250101, 20250201]
    assert sum(r.rows for r in report) == 40000


def test_range_and_status_queries(airline):
    june = airline.month_sales(20250601, 20250701).first()
    plain = airline.fact.where("travel_date_key between 20250601 and 20250630")
    assert june["bookings"] == plain.count() == airline.partition_report().collect()[6].rows
    status = airline.status_sales("Confirmed", "Business").first()
    assert status["bookings"] == sum(1 for i in range(40000) if i % 3 == 0 and i % 4 == 2)
    read = partitions_read(airline.fact, "june", month_range(20250601, 20250701)).first()
    assert (read["partitions_read"], read["partitions_total"]) == (1, 15)


def test_rollups(airline):
    total = rollup(airline.fact, TICKET_SALES, [], ["total_fare", "average_fare"]).first()
    assert total["bookings"] == 40000
    assert total["average_fare"] == pytest.approx(float(total["total_fare"]) / 40000)


def test_the_next_day_points_new_bookings_at_new_versions(spark, airline, layers, tmp_path):
    """Passenger 700000 moved up on the first day and books on the second; one month is written."""
    day, travels = AS_OF.replace(day=2), date(2026, 9, 20)
    made = feeds(spark)
    flight = made["flight"].limit(1).withColumns({"flight_id": F.lit(5000).cast("long"), "flight_date": F.lit(travels)})
    new = {"booking_id": F.lit(50000).cast("long"), "booking_date": F.lit(day), "travel_date": F.lit(travels)}
    booking = made["bookings"].where("booking_id = 0").withColumns({**new, "flight_id": F.lit(5000).cast("long")})
    made |= {"flight": made["flight"].unionByName(flight), "bookings": made["bookings"].unionByName(booking)}
    made["updates"] = made["updates"].where("passenger_id >= 900000")
    for name, df in made.items():
        df.write.option("header", True).csv(str(tmp_path / FILES[name]))
    store = FactStore(spark, f"{layers.gold}.fact_ticket_sales", TICKET_SALES, "travel_date_key")
    before = set(store.stored.entries())
    second = load(spark, str(tmp_path), day, arrived(spark, 5, day), layers)
    found = second.fact.where("booking_id = 50000").join(second.history, "passenger_key").first()
    assert (found["frequent_flyer_tier"], found["effective_from"]) == ("Silver", AS_OF)
    assert before < set(store.stored.entries())
    assert {e.value for e in set(store.stored.entries()) - before} == {"202609"}


def test_rows_that_do_not_fit_their_types_are_set_aside(spark, folder, tmp_path):
    for name in FILES:
        (tmp_path / FILES[name]).write_text(",".join(SCHEMAS[name].names) + "\n")
    with open(tmp_path / FILES["bookings"], "a") as file:
        file.write("1,7,8,2025-01-01,2025-02-01,Economy,10.50,1,Confirmed,300\n")
        file.write("2,7,8,01/01/2025,2025-02-01,Economy,10.505,1,Confirmed,many\n")
        file.write("3,7\n")
    rows_, quarantined = read_feeds(spark, str(tmp_path))["bookings"]
    assert rows(rows_, "booking_id", "fare_amount") == [(1, Decimal("10.50"))]
    assert rows_.schema == SCHEMAS["bookings"]
    assert {tuple(r["reasons"]) for r in quarantined.collect()} == {
        ("booking_date is no date", "fare_amount is no decimal(18,2)", "miles_earned is no bigint"),
        ("not the declared columns",),
    }


def test_a_file_of_wrong_lines_is_quarantined(spark, folder, tmp_path):
    for name in FILES:
        header = ",".join(SCHEMAS[name].names)
        (tmp_path / FILES[name]).write_text(header + "\n" + ("x," * header.count(",")) + "y\n")
    got = read_feeds(spark, str(tmp_path))
    assert got["bookings"].rows.count() == 0 and got["bookings"].quarantined.count() == 1
    assert got["airport"].rows.count() == 1
    assert CONTRACT.names == SCHEMAS["bookings"].names
