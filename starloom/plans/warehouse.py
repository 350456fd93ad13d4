"""The ticket-sales warehouse over the given tables.

The given tables stand in for an airline's feeds: orders are bookings, customers
passengers, parts flights, nations airports, suppliers a larger geography. The
warehouse's own tables (keyed dimensions, loaded fact, history) are written once
per session and table folder, as a warehouse would keep them.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions.columns import code
from starloom.functions.dates import date_key
from starloom.model import Dimension, Fact, History, Level, Measure, Parent, Ratio
from starloom.operators.contract import Contract, ContractColumn, ForeignKey
from starloom.operators.dims import build_dim, calendar_for, snowflake
from starloom.operators.facts import Load, load_fact
from starloom.operators.joins import lookup
from starloom.operators.scd2 import Applied, prepare_feed, scd2_apply, scd2_init
from starloom.session import new_path, stage
from starloom.sources.sinks import write_partitioned

# The days the change feeds take effect, the ranks a changed
# passenger moves through, where ids of new passengers begin.
AS_OF = date(1998, 7, 1)
LATE_DAY, LATER_DAY = date(1998, 6, 1), date(1998, 7, 21)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
NEW_IDS = 9_000_000_000

# The columns of the dimensions, of the fact and of their feeds.
AIRPORT = Dimension(
    "airport",
    "airport_key",
    ["airport_code"],
    {c: c for c in ("airport_code", "airport_name", "city", "country", "region")},
)
AIRCRAFT = Dimension(
    "aircraft",
    "aircraft_key",
    ["aircraft_code"],
    {c: c for c in ("aircraft_code", "model", "manufacturer", "seat_capacity")},
)
GEOGRAPHY = [
    Level("country", "country_key", {"country": "country_name"}, {"region": "region"}),
    Level("city", "city_key", {"city": "city_name"}),
]
PASSENGER = Dimension(
    "passenger",
    "passenger_key",
    ["passenger_id"],
    {c: c for c in ("passenger_id", "passenger_name", "frequent_flyer_tier", "signup_date")},
    (
        Parent(
            "home airport",
            "airport",
            {"home_airport_code": "airport_code"},
            "airport_key",
            "home_airport_key",
        ),
    ),
)
FLIGHT = Dimension(
    "flight",
    "flight_key",
    ["flight_id"],
    {c: c for c in ("flight_id", "flight_number", "flight_date")},
    (
        Parent(
            "origin airport",
            "airport",
            {"origin_airport_code": "airport_code"},
            "airport_key",
            "origin_airport_key",
        ),
        Parent(
            "destination airport",
            "airport",
            {"dest_airport_code": "airport_code"},
            "airport_key",
            "dest_airport_key",
        ),
        Parent(
            "aircraft",
            "aircraft",
            {"aircraft_code": "aircraft_code"},
            "aircraft_key",
            "aircraft_key",
        ),
    ),
)
TICKET_SALES = Fact(
    "ticket_sales",
    ["booking_id"],
    (
        Parent("booking date", "date", {"booking_date": "full_date"}, "date_key", "booking_date_key"),
        Parent("travel date", "date", {"travel_date": "full_date"}, "date_key", "travel_date_key"),
        Parent(
            "passenger",
            "passenger",
            {"passenger_id": "passenger_id"},
            "passenger_key",
            "passenger_key",
        ),
        Parent("flight", "flight", {"flight_id": "flight_id"}, "flight_key", "flight_key"),
    ),
    ["fare_class", "booking_status", "fare_amount", "tax_amount", "miles_earned"],
    measures=(
        Measure("total_fare", "fare_amount"),
        Measure("total_tax", "tax_amount"),
        Measure("total_miles", "miles_earned"),
        Measure("fare_per_mile", "fare_per_mile", additive=False),
    ),
    ratios=(Ratio("average_fare", "total_fare"), Ratio("fare_by_mile", "total_fare", "total_miles")),
    narrow=("miles_earned",),
)
HISTORY = History()

BOOKING_CONTRACT = Contract(
    columns=(
        ContractColumn("booking_id", "bigint"),
        ContractColumn("passenger_id", "bigint"),
        ContractColumn("flight_id", "bigint"),
        ContractColumn("booking_date", "date"),
        ContractColumn("travel_date", "date"),
        ContractColumn(
            "fare_class", "string", allowed=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
        ),
        ContractColumn("fare_amount", "decimal(18,2)", minimum=0),
        ContractColumn("tax_amount", "decimal(18,2)", minimum=0),
        ContractColumn("booking_status", "string", allowed=("F", "O")),
        ContractColumn("miles_earned", "bigint", minimum=0),
    ),
    unique=("booking_id",),
    references=(
        ForeignKey("passenger_id", "passengers", "passenger_id"),
        ForeignKey("flight_id", "flights", "flight_id"),
    ),
    row_rules={"booked after travel": "booking_date > travel_date"},
)


class Warehouse:
    """Frames over one folder of given tables, and the tables built from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- feeds -----------------------------------------------------------------

    @property
    def countries(self) -> DataFrame:
        return lookup(
            self.table("nation"), self.table("region"), {"n_regionkey": "r_regionkey"}, {"r_name": "region"}
        )

    @property
    def airports(self) -> DataFrame:
        return self.countries.select(
            code(F.col("n_name")).alias("airport_code"),
            F.concat("n_name", F.lit(" Intl")).alias("airport_name"),
            F.concat(F.lit("City "), F.col("n_nationkey") % 7).alias("city"),
            F.col("n_name").alias("country"),
            "region",
        )

    @property
    def geography(self) -> DataFrame:
        """One airport per supplier; a city's name recurs in many countries."""
        located = lookup(
            self.table("supplier"),
            self.countries,
            {"s_nationkey": "n_nationkey"},
            {"n_name": "country", "region": "region"},
        )
        return located.select(
            code(F.col("s_name")).alias("airport_code"),
            F.concat("s_name", F.lit(" Field")).alias("airport_name"),
            F.concat(F.lit("City "), F.col("s_suppkey") % 40).alias("city"),
            "country",
            "region",
        )

    @property
    def aircraft(self) -> DataFrame:
        return (
            self.table("part")
            .groupBy(code(F.col("p_brand")).alias("aircraft_code"))
            .agg(
                F.min("p_type").alias("model"),
                F.min("p_name").alias("manufacturer"),
                F.max("p_size").cast("long").alias("seat_capacity"),
            )
        )

    @property
    def flights(self) -> DataFrame:
        days = (F.col("p_partkey") * 37 % 2400).cast("int")
        return self.table("part").select(
            F.col("p_partkey").alias("flight_id"),
            F.col("p_name").alias("flight_number"),
            F.concat(F.lit("NATION_"), F.col("p_partkey") % 25).alias("origin_airport_code"),
            F.concat(F.lit("NATION_"), F.col("p_size") % 25).alias("dest_airport_code"),
            code(F.col("p_brand")).alias("aircraft_code"),
            F.date_add(F.lit(date(1995, 1, 1)), days).alias("flight_date"),
        )

    @property
    def passengers(self) -> DataFrame:
        days = (F.col("c_custkey") % 365).cast("int")
        signup = F.when(F.col("c_custkey") % 50 == 0, F.lit(date(1996, 1, 1))).otherwise(
            F.date_sub(F.lit(date(1995, 1, 1)), days)
        )
        return self.table("customer").select(
            F.col("c_custkey").alias("passenger_id"),
            F.col("c_name").alias("passenger_name"),
            F.concat(F.lit("NATION_"), "c_nationkey").alias("home_airport_code"),
            F.col("c_mktsegment").alias("frequent_flyer_tier"),
            signup.alias("signup_date"),
        )

    @property
    def booking_feed(self) -> DataFrame:
        """One row per order; its flight, tax and miles come from its lines."""
        lines = self.table("lineitem")
        per_order = lines.groupBy(F.col("l_orderkey").alias("booking_id")).agg(
            F.min("l_partkey").alias("flight_id"),
            F.sum(F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,2)").alias("tax_amount"),
            F.sum(F.col("l_quantity").cast("long")).alias("miles_earned"),
        )
        booked = F.col("o_orderdate").cast("date")
        days = (F.col("o_orderkey") % 90).cast("int")
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("booking_id"),
            F.col("o_custkey").alias("passenger_id"),
            booked.alias("booking_date"),
            F.date_add(booked, days).alias("travel_date"),
            F.col("o_orderpriority").alias("fare_class"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("fare_amount"),
            F.col("o_orderstatus").alias("booking_status"),
        )
        return orders.join(per_order.hint("shuffle_hash"), "booking_id", "left").select(*BOOKING_CONTRACT.names)

    @property
    def lines(self) -> DataFrame:
        """The line fact: large, and with no unique key of its own."""
        travelled = F.col("l_shipdate").cast("date")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("booking_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("flight_id"),
            F.col("l_suppkey").alias("supplier_id"),
            travelled.alias("travel_date"),
            date_key(travelled).alias("travel_date_key"),
            F.col("l_returnflag").alias("fare_class"),
            F.col("l_linestatus").alias("booking_status"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("fare_amount"),
            F.col("l_quantity").cast("long").alias("miles_earned"),
        )

    @property
    def updates(self) -> DataFrame:
        """The day's change feed: every known passenger, and suppliers as new ones.

        Some passengers change their tier, their home airport or both; some only
        their name, which opens no new version; the others stay as they are.
        """
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        both = key % 15 == 8
        tiers = F.array(*[F.lit(s) for s in SEGMENTS])
        next_tier = F.element_at(tiers, (F.array_position(tiers, F.col("c_mktsegment")) % 5 + 1).cast("int"))
        renamed = F.concat("c_name", F.lit(" (renamed)"))
        known = self.table("customer").select(
            key.alias("passenger_id"),
            F.when(key % 15 == 11, renamed).otherwise(F.col("c_name")).alias("passenger_name"),
            F.concat(
                F.lit("NATION_"), F.when(both | (key % 30 == 16), (nation + 1) % 25).otherwise(nation)
            ).alias("home_airport_code"),
            F.when(both | (key % 30 == 1), next_tier)
            .otherwise(F.col("c_mktsegment"))
            .alias("frequent_flyer_tier"),
        )
        new = self.table("supplier").select(
            (F.col("s_suppkey") + NEW_IDS).alias("passenger_id"),
            F.col("s_name").alias("passenger_name"),
            F.concat(F.lit("NATION_"), "s_nationkey").alias("home_airport_code"),
            F.lit(SEGMENTS[0]).alias("frequent_flyer_tier"),
        )
        return known.unionByName(new)

    @property
    def late_updates(self) -> DataFrame:
        """A feed of ``LATE_DAY``: some tiers and homes as later days have them, some not."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        known = self.table("customer").select(
            key.alias("passenger_id"),
            F.concat("c_name", F.lit(" (late)")).alias("passenger_name"),
            F.concat(F.lit("NATION_"), F.when(key % 3 == 0, (nation + 1) % 25).otherwise(nation)).alias("home_airport_code"),
            F.when(key % 10 < 3, F.lit(SEGMENTS[2])).otherwise(F.col("c_mktsegment")).alias("frequent_flyer_tier"),
        )
        new = self.table("supplier").select(
            (F.col("s_suppkey") + NEW_IDS).alias("passenger_id"),
            F.concat("s_name", F.lit(" (late)")).alias("passenger_name"),
            F.concat(F.lit("NATION_"), "s_nationkey").alias("home_airport_code"),
            F.lit(SEGMENTS[1]).alias("frequent_flyer_tier"),
        )
        return known.unionByName(new.where("passenger_id % 2 = 0"))

    @property
    def later_updates(self) -> DataFrame:
        """A feed after that of ``AS_OF``: most passengers are again what they were at first."""
        return self.table("customer").select(
            F.col("c_custkey").alias("passenger_id"),
            F.concat("c_name", F.lit(" (later)")).alias("passenger_name"),
            F.concat(F.lit("NATION_"), "c_nationkey").alias("home_airport_code"),
            F.when(F.col("c_custkey") % 4 == 1, F.lit(SEGMENTS[4])).otherwise(F.col("c_mktsegment")).alias("frequent_flyer_tier"),
        )

    def feed(self, updates: DataFrame) -> DataFrame:
        """The accepted rows of a change feed."""
        return prepare_feed(updates, HISTORY, PASSENGER.parents, {"airport": self.dim_airport}).accepted

    @property
    def arrivals(self) -> DataFrame:
        """A feed per user; its deliveries are the user's events."""
        return self.table("events").select(
            F.concat(F.lit("user "), "user_id").alias("feed"),
            F.col("ts").cast("date").alias("business_date"),
            F.col("ts").cast("timestamp_ntz").alias("landed_at"),
        )

    # -- tables the warehouse keeps ----------------------------------------------

    @cached_property
    def bookings_path(self) -> str:
        path = new_path(self.spark, "bookings")
        self.booking_feed.write.parquet(path)
        return path

    @property
    def bookings(self) -> DataFrame:
        """The landed booking feed."""
        return self.spark.read.schema(self.booking_feed.schema).parquet(self.bookings_path)

    @cached_property
    def calendar(self) -> DataFrame:
        return stage(calendar_for(self.bookings, "booking_date", "travel_date"), "calendar")

    @cached_property
    def dim_airport(self) -> DataFrame:
        return build_dim(self.airports, AIRPORT)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return build_dim(self.geography, AIRPORT)

    @cached_property
    def geography_levels(self) -> dict[str, DataFrame]:
        return snowflake(self.dim_geography, GEOGRAPHY, "airport")

    @cached_property
    def dim_aircraft(self) -> DataFrame:
        return build_dim(self.aircraft, AIRCRAFT)

    @cached_property
    def dim_passenger(self) -> DataFrame:
        return build_dim(self.passengers, PASSENGER, {"airport": self.dim_airport})

    @cached_property
    def dim_flight(self) -> DataFrame:
        dims = {"airport": self.dim_airport, "aircraft": self.dim_aircraft}
        return build_dim(self.flights, FLIGHT, dims)

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {
            "date": self.calendar,
            "passenger": self.dim_passenger,
            "flight": self.dim_flight,
        }

    @cached_property
    def load(self) -> Load:
        return load_fact(self.bookings, TICKET_SALES, self.dims)

    @cached_property
    def initial_history(self) -> DataFrame:
        return scd2_init(self.dim_passenger, HISTORY)

    @cached_property
    def applied(self) -> Applied:
        parents, dims = PASSENGER.parents, {"airport": self.dim_airport}
        feed = prepare_feed(self.updates, HISTORY, parents, dims)
        return scd2_apply(self.initial_history, feed.accepted, HISTORY, AS_OF)

    @cached_property
    def dim_history(self) -> DataFrame:
        return stage(self.applied.dimension, "passenger-history")

    @cached_property
    def booking_fact_path(self) -> str:
        path = new_path(self.spark, "booking-fact")
        return write_partitioned(self.load.fact, path, "travel_date_key", TICKET_SALES.grain)

    @property
    def booking_fact(self) -> DataFrame:
        """The booking fact in its month partitions."""
        schema = T.StructType([*self.load.fact.schema, T.StructField("travel_month", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.booking_fact_path)

    @cached_property
    def line_fact_path(self) -> str:
        path = new_path(self.spark, "line-fact")
        return write_partitioned(self.lines, path, "travel_date_key", ["booking_id", "line_number"])

    @property
    def line_fact_schema(self) -> T.StructType:
        return T.StructType([*self.lines.schema, T.StructField("travel_month", T.IntegerType())])

    @property
    def line_fact(self) -> DataFrame:
        return self.spark.read.schema(self.line_fact_schema).parquet(self.line_fact_path)


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The session's warehouse over ``folder``."""
    at = (spark.sparkContext.applicationId, folder)
    if at not in _OPEN:
        _OPEN[at] = Warehouse(spark, folder)
    return _OPEN[at]
