"""The airline's own warehouse: six CSV feeds in, verified star schema out."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions.columns import code
from starloom.operators import checks, partitions, scd2
from starloom.operators.contract import (
    Contract,
    ContractColumn,
    CrossRule,
    ForeignKey,
    check_cross_table,
    conform,
    expected_days,
    freshness,
    local_time,
)
from starloom.operators.dims import resolve_levels, snowflake
from starloom.plans.refresh import Layers, gate_freshness, keep_profiles, rebuild_fact, refresh_inputs
from starloom.plans.warehouse import (
    AIRCRAFT,
    AIRPORT,
    FLIGHT,
    GEOGRAPHY,
    HISTORY,
    PASSENGER,
    TICKET_SALES,
)
from starloom.sources.history import HistoryStore
from starloom.sources.readers import Csv, read_csv
from starloom.sources.sinks import replace_table

_TEXT, _NUMBER, _DATE, _MONEY = T.StringType(), T.LongType(), T.DateType(), T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# File names, columns, allowed values and calendar of the feeds.
FILES = {
    "airport": "bronze_airports.csv",
    "aircraft": "bronze_aircraft.csv",
    "passenger": "bronze_passengers.csv",
    "flight": "bronze_flights.csv",
    "bookings": "bronze_bookings.csv",
    "updates": "stg_passenger_updates.csv",
}
SCHEMAS = {
    "airport": _schema(
        airport_code=_TEXT, airport_name=_TEXT, city=_TEXT, country=_TEXT, region=_TEXT
    ),
    "aircraft": _schema(aircraft_code=_TEXT, model=_TEXT, manufacturer=_TEXT, seat_capacity=_NUMBER),
    "passenger": _schema(
        passenger_id=_NUMBER,
        passenger_name=_TEXT,
        home_airport_code=_TEXT,
        frequent_flyer_tier=_TEXT,
        signup_date=_DATE,
    ),
    "flight": _schema(
        flight_id=_NUMBER,
        flight_number=_TEXT,
        origin_airport_code=_TEXT,
        dest_airport_code=_TEXT,
        aircraft_code=_TEXT,
        flight_date=_DATE,
    ),
    "bookings": _schema(
        booking_id=_NUMBER,
        passenger_id=_NUMBER,
        flight_id=_NUMBER,
        booking_date=_DATE,
        travel_date=_DATE,
        fare_class=_TEXT,
        fare_amount=_MONEY,
        tax_amount=_MONEY,
        booking_status=_TEXT,
        miles_earned=_NUMBER,
    ),
    "updates": _schema(
        passenger_id=_NUMBER, passenger_name=_TEXT, home_airport_code=_TEXT, frequent_flyer_tier=_TEXT
    ),
}
FARE_CLASSES = ("Economy", "Premium Economy", "Business", "First")
STATUSES = ("Confirmed", "Cancelled", "NoShow")
CALENDAR = (date(2024, 1, 1), date(2026, 12, 31))

CONTRACT = Contract(
    columns=(
        ContractColumn("booking_id", "bigint"),
        ContractColumn("passenger_id", "bigint"),
        ContractColumn("flight_id", "bigint"),
        ContractColumn("booking_date", "date"),
        ContractColumn("travel_date", "date"),
        ContractColumn("fare_class", "string", allowed=FARE_CLASSES),
        ContractColumn("fare_amount", "decimal(18,2)", minimum=0),
        ContractColumn("tax_amount", "decimal(18,2)", minimum=0),
        ContractColumn("booking_status", "string", allowed=STATUSES),
        ContractColumn("miles_earned", "bigint", minimum=0),
    ),
    unique=("booking_id",),
    references=(
        ForeignKey("passenger_id", "passenger", "passenger_id"),
        ForeignKey("flight_id", "flight", "flight_id"),
    ),
    row_rules={"booked after travel": "booking_date > travel_date"},
    cross_rules=(
        CrossRule(
            "travel date is not the flight's",
            "flight",
            {"flight_id": "flight_id"},
            {"flight_date": "flight_date"},
            "travel_date <> flight_date",
        ),
    ),
)


# The declared types of the dimensions' columns.
TYPES = {
    "airport": {
        "airport_code": "char(3)",
        "airport_name": "varchar(100)",
        "city": "varchar(100)",
        "country": "varchar(100)",
        "region": "varchar(50)",
    },
    "aircraft": {
        "aircraft_code": "varchar(20)",
        "model": "varchar(50)",
        "manufacturer": "varchar(50)",
        "seat_capacity": "int",
    },
    "passenger": {"passenger_name": "varchar(100)", "frequent_flyer_tier": "varchar(20)", "signup_date": "date"},
    "flight": {"flight_number": "varchar(10)", "flight_date": "date"},
}
DIMENSIONS = [replace(d, types=TYPES[d.name]) for d in (AIRPORT, AIRCRAFT, PASSENGER, FLIGHT)]


def read_feeds(spark: SparkSession, folder: str) -> dict[str, Csv]:
    """All feeds landed with their declared types, codes brought to one form.

    Bookings are read as text and cast row by row, so that a row that is set aside
    tells which of its columns hold no value of their type.
    """
    feeds = {}
    for name, file in FILES.items():
        if name == "bookings":
            feeds[name] = _read_bookings(spark, f"{folder}/{file}")
            continue
        rows, quarantined = read_csv(spark, f"{folder}/{file}", SCHEMAS[name])
        codes = {c: code(F.col(c)) for c in rows.columns if c.endswith("_code")}
        feeds[name] = Csv(rows.withColumns(codes) if codes else rows, quarantined)
    return feeds


def _read_bookings(spark: SparkSession, path: str) -> Csv:
    text = T.StructType([T.StructField(n, _TEXT) for n in SCHEMAS["bookings"].names])
    lines, malformed = read_csv(spark, path, text)
    typed, wrong = conform(lines, CONTRACT)
    set_aside = wrong.select(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in text.names]).alias("line"), "reasons")
    unreadable = malformed.select("line", F.array(F.lit("not the declared columns")).alias("reasons"))
    return Csv(typed, set_aside.unionByName(unreadable))


def file_arrivals(spark: SparkSession, folder: str, business_date: date) -> DataFrame:
    """When each feed's file of a day was last written; contents are not read."""
    found = []
    for name, file in FILES.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/{file}")
        landed = local_time(F.col("modificationTime")).alias("landed_at")
        found.append(files.select(F.lit(name).alias("feed"), F.lit(business_date).alias("business_date"), landed))
    return reduce(DataFrame.unionByName, found)


@dataclass(frozen=True)
class Airline:
    """The loaded warehouse; its methods are the acceptance reports."""

    feeds: dict[str, DataFrame]
    dims: dict[str, DataFrame]
    geography: dict[str, DataFrame]
    history: DataFrame
    fact: DataFrame

    def row_counts(self) -> DataFrame:
        return checks.row_count_report({FILES[n][:-4]: df for n, df in self.feeds.items()})

    def reconciliation(self) -> DataFrame:
        return checks.reconcile(self.feeds["bookings"], self.fact)

    def orphans(self) -> DataFrame:
        dims = {**self.dims, "passenger": self.history}
        return checks.orphan_check(
            self.fact,
            {
                p.role.replace(" ", "_"): (p.result, dims[p.dimension], p.key)
                for p in TICKET_SALES.parents
            },
        )

    def places(self) -> DataFrame:
        columns = ["airport_code", "airport_name"]
        return resolve_levels(self.geography, GEOGRAPHY, "airport", columns)

    def versions(self) -> DataFrame:
        return scd2.scd2_version_counts(self.history, HISTORY)

    def versions_of(self, passenger_id: int) -> DataFrame:
        return scd2.scd2_history(self.history, HISTORY, F.col("passenger_id") == passenger_id)

    def not_one_current(self) -> DataFrame:
        return scd2.scd2_not_one_current(self.history, HISTORY)

    def off_schedule(self) -> DataFrame:
        """Bookings checked against their flight's date."""
        return check_cross_table(
            self.feeds["bookings"],
            self.feeds["flight"],
            {"flight_id": "flight_id"},
            {"flight_date": "flight_date"},
            F.col("travel_date") != F.col("flight_date"),
        )

    def boundaries(self) -> list[int]:
        return partitions.boundary_keys(self.feeds["bookings"], "travel_date")

    def partition_report(self) -> DataFrame:
        return partitions.partition_report(self.fact, "travel_date_key", self.boundaries())

    def month_sales(self, low: int, high: int) -> DataFrame:
        """Bookings and fare of the travel dates in ``[low, high)``."""
        rows = partitions.pruned_range(self.fact, low, high)
        return partitions.range_total(rows, "fare_amount")

    def status_sales(self, status: str, fare_class: str) -> DataFrame:
        wanted = (F.col("booking_status") == status) & (F.col("fare_class") == fare_class)
        return partitions.range_total(self.fact.where(wanted), "fare_amount")


def load(
    spark: SparkSession, folder: str, as_of: date, arrivals: DataFrame, layers: Layers = Layers()
) -> Airline:
    """Load one day: gates, dimensions, the passengers' changes, then the fact as of its days.

    The first load begins the passengers' history; a later day's load, or one that runs
    again after it died, goes on with it. A day may come late. ``arrivals`` says when the
    feeds landed (see ``file_arrivals``); a feed that is not there in time stops the day.
    """
    expected = expected_days(spark.createDataFrame([(n,) for n in FILES], "feed string"), as_of, as_of)
    deliveries = freshness(arrivals, expected), as_of
    gate_freshness(*deliveries)
    read = read_feeds(spark, folder)
    feeds = {name: feed.rows for name, feed in read.items()}
    daily = {n: df for n, df in feeds.items() if n != "updates"}
    inputs = refresh_inputs(spark, layers, daily, CONTRACT, DIMENSIONS, CALENDAR, deliveries)
    replace_table(read["bookings"].quarantined, f"{layers.bronze}.bookings_unreadable")
    dims = inputs.dims
    geography = {
        level: replace_table(df, f"{layers.silver}.geo_{level}")
        for level, df in snowflake(dims["airport"], GEOGRAPHY, "airport").items()
    }
    store = HistoryStore(spark, f"{layers.silver}.passenger_history", HISTORY)
    if not store.exists():
        store.create(scd2.scd2_init(dims["passenger"], HISTORY))
    changes = scd2.prepare_feed(feeds["updates"], HISTORY, PASSENGER.parents, dims)
    replace_table(changes.rejects, f"{layers.silver}.passenger_history_rejects")
    store.apply(changes.accepted, as_of)
    versions = {**dims, "passenger": store.read()}
    history = {"passenger": (HISTORY, "booking_date")}
    fact = rebuild_fact(spark, layers, inputs.bookings, TICKET_SALES, versions, history=history)
    keep_profiles(layers, inputs)
    return Airline(feeds, dims, geography, store.read(), fact)
