"""The registered queries: each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.dates import month_of
from starloom.model import Fact, Measure, Ratio
from starloom.operators import checks, contract as rules, partitions, profile, scd2
from starloom.operators.dims import calendar_for, project_dim, resolve_levels, split_dim
from starloom.operators.facts import asof_lookup, load_fact_asof
from starloom.operators.joins import lookup
from starloom.operators.keys import assign_keys
from starloom.operators.rollup import rollup
from starloom.plans.warehouse import (
    AIRCRAFT,
    AS_OF,
    BOOKING_CONTRACT,
    GEOGRAPHY,
    HISTORY,
    LATE_DAY,
    LATER_DAY,
    PASSENGER,
    TICKET_SALES,
    Warehouse,
    warehouse,
)
from starloom.session import new_path, stage
from starloom.sources import footers
from starloom.sources.facts import FactStore
from starloom.sources.history import HistoryStore
from starloom.sources.readers import read_csv, read_text_columns
from starloom.sources.sinks import replace_table
from starloom.streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LOW, HIGH = 19980601, 19980701  # the travel month of the range queries


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(warehouse(spark, folder))
    return build


def _long(*names: str) -> dict[str, F.Column]:
    return {n: F.col(n).cast("long") for n in names}


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("decimal(38,2)") for n in names})


# -- sources and sinks -----------------------------------------------------------


@query
def csv_bronze_roundtrip(w: Warehouse) -> DataFrame:
    """Bookings written as CSV and read back through the declared schema."""
    path = new_path(w.spark, "bookings-csv")
    w.bookings.write.option("header", True).csv(path)
    return read_csv(w.spark, path, w.bookings.schema).rows


@query
def full_refresh_idempotent(w: Warehouse) -> DataFrame:
    """The passenger feed after two full refreshes, the second reading the first."""
    table = f"refresh_{new_path(w.spark, 'x')[-8:]}"
    first = replace_table(w.passengers, table)
    return replace_table(first, table)


@query
def fact_partitioned_write(w: Warehouse) -> DataFrame:
    return w.line_fact.withColumns(_long("travel_date_key", "travel_month", "line_number"))


@query
def row_count_report(w: Warehouse) -> DataFrame:
    return checks.row_count_report(
        {
            "airports": w.airports,
            "aircraft": w.aircraft,
            "passengers": w.passengers,
            "flights": w.flights,
            "bookings": w.bookings,
            "updates": w.updates,
        }
    )


@query
def partition_report(w: Warehouse) -> DataFrame:
    """Rows of the stored line fact, all from its files' footers."""
    stored = w.spark, w.line_fact_path, w.line_fact_schema
    boundaries = partitions.boundaries_between(*footers.date_ranges(*stored, "travel_date").first())
    report = partitions.partition_report_by_month(footers.month_counts(*stored), boundaries)
    return report.withColumns(_long("partition_number", "upper_boundary_key"))


# -- dimensions and keys ---------------------------------------------------------


@query
def calendar_dim(w: Warehouse) -> DataFrame:
    """The calendar from the first booking to the last journey."""
    days = calendar_for(w.bookings, "booking_date", "travel_date")
    return days.withColumns(_long("date_key", "year", "quarter", "month_number", "day"))


@query
def surrogate_keys(w: Warehouse) -> DataFrame:
    return assign_keys(w.passengers, ["passenger_id"], "passenger_key").select(
        "passenger_id", "passenger_key"
    )


@query
def surrogate_keys_incremental(w: Warehouse) -> DataFrame:
    """Known passengers keep their keys, new ones continue after the largest."""
    keyed = assign_keys(w.updates, ["passenger_id"], "passenger_key", w.dim_passenger)
    return keyed.select("passenger_id", "passenger_key")


@query
def dim_flat_projection(w: Warehouse) -> DataFrame:
    return w.dim_geography


@query
def dim_passenger(w: Warehouse) -> DataFrame:
    return w.dim_passenger


@query
def dim_flight(w: Warehouse) -> DataFrame:
    return w.dim_flight


@query
def key_lookup(w: Warehouse) -> DataFrame:
    rows = project_dim(w.passengers, PASSENGER, {"airport": w.dim_airport})
    return rows.select("passenger_id", "home_airport_key")


@query
def role_playing_join(w: Warehouse) -> DataFrame:
    """Lines between the supplier's nation and the customer's, on one dimension."""
    nation = lookup(
        w.table("nation"), w.table("region"), {"n_regionkey": "r_regionkey"}, {"r_name": "region"}
    )
    routed = _routes(w)
    named = lookup(
        routed, nation, {"origin_nation": "n_nationkey"}, {"n_name": "origin", "region": "origin_region"}
    )
    named = lookup(
        named, nation, {"dest_nation": "n_nationkey"}, {"n_name": "dest", "region": "dest_region"}
    )
    totals = named.groupBy("origin", "origin_region", "dest", "dest_region").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("fare_amount").alias("total_fare")
    )
    return _money(totals, "total_fare")


def _routes(w: Warehouse) -> DataFrame:
    """Lines with the nations they go between."""
    customers = w.table("customer")
    orders = lookup(
        w.table("orders"), customers, {"o_custkey": "c_custkey"}, {"c_nationkey": "nation"}
    )
    sent = lookup(
        w.lines, w.table("supplier"), {"supplier_id": "s_suppkey"}, {"s_nationkey": "origin_nation"}
    )
    dest = {"nation": "dest_nation"}
    return lookup(sent, orders, {"booking_id": "o_orderkey"}, dest, keys_of=w.lines, large=True)


@query
def booking_flight_enrich(w: Warehouse) -> DataFrame:
    names = ("flight_number", "origin_airport_code", "dest_airport_code", "aircraft_code", "flight_date")
    rows = lookup(w.bookings, w.flights, {"flight_id": "flight_id"}, {n: n for n in names})
    return rows.select("booking_id", "flight_id", "travel_date", *names)


# -- geography -------------------------------------------------------------------


@query
def snowflake_country(w: Warehouse) -> DataFrame:
    return w.geography_levels["country"]


@query
def snowflake_city(w: Warehouse) -> DataFrame:
    return w.geography_levels["city"]


@query
def snowflake_airport(w: Warehouse) -> DataFrame:
    return w.geography_levels["airport"]


@query
def snowflake_resolve(w: Warehouse) -> DataFrame:
    columns = ["airport_code", "airport_name"]
    return resolve_levels(w.geography_levels, GEOGRAPHY, "airport", columns)


# -- facts -----------------------------------------------------------------------


def _fact_result(fact: DataFrame) -> DataFrame:
    keys = ("booking_date_key", "travel_date_key", "miles_earned")
    return fact.withColumns(_long(*keys))


@query
def fact_load(w: Warehouse) -> DataFrame:
    return _fact_result(w.load.fact)


@query
def fact_rejects(w: Warehouse) -> DataFrame:
    return w.load.rejects.select("booking_id", F.array_join("reasons", ", ").alias("reason"))


@query
def fact_reconciliation(w: Warehouse) -> DataFrame:
    return checks.reconcile(w.bookings, w.load.fact)


@query
def orphan_check(w: Warehouse) -> DataFrame:
    """Rows of the loaded fact that point at no row of a dimension."""
    loaded = w.load.fact
    return checks.orphan_check(
        loaded,
        {
            "booking_date": ("booking_date_key", w.calendar, "date_key"),
            "travel_date": ("travel_date_key", w.calendar, "date_key"),
            "passenger": ("passenger_key", w.dim_passenger, "passenger_key"),
            "flight": ("flight_key", w.dim_flight, "flight_key"),
        },
    )


@query
def orphan_values(w: Warehouse) -> DataFrame:
    """Bookings that no line belongs to."""
    return checks.orphans(w.bookings, "booking_id", w.lines, "booking_id")


@query
def asof_fact_load(w: Warehouse) -> DataFrame:
    return _fact_result(_asof(w).fact)


@query
def asof_rejects(w: Warehouse) -> DataFrame:
    return _asof(w).rejects.select("booking_id", F.array_join("reasons", ", ").alias("reason"))


def _asof(w: Warehouse):
    dims = {**w.dims, "passenger": w.dim_history}
    return load_fact_asof(
        w.bookings, TICKET_SALES, dims, {"passenger": (HISTORY, "booking_date")}
    )


@query
def asof_vs_current(w: Warehouse) -> DataFrame:
    """How many bookings point elsewhere when resolved by the current version."""
    on = {"passenger_id": "passenger_id"}
    then = asof_lookup(
        w.bookings, w.dim_history, HISTORY, on, "booking_date", {"passenger_key": "key_then"}
    )
    now = lookup(
        then, w.dim_history.where("is_current"), on, {"passenger_key": "key_now"}, "left", keys_of=w.bookings
    )
    return now.agg(
        F.count(F.lit(1)).alias("bookings"),
        F.count_if(F.col("key_then").isNull()).alias("unmatched_then"),
        F.count_if(F.col("key_then") == F.col("key_now")).alias("same_version"),
        F.count_if(F.col("key_then") != F.col("key_now")).alias("other_version"),
    )


# -- history ---------------------------------------------------------------------


@query
def scd2_init(w: Warehouse) -> DataFrame:
    return w.initial_history


@query
def scd2_change_set(w: Warehouse) -> DataFrame:
    return w.applied.changes


@query
def scd2_change_profile(w: Warehouse) -> DataFrame:
    return scd2.scd2_change_profile(w.applied.changes, HISTORY)


@query
def scd2_apply(w: Warehouse) -> DataFrame:
    return w.dim_history


@query
def scd2_history(w: Warehouse) -> DataFrame:
    """All versions of the passengers who have more than one, oldest first."""
    closed = w.dim_history.where("not is_current").select("passenger_id").distinct()
    several = lookup(w.dim_history, closed, {"passenger_id": "passenger_id"}, how="left_semi")
    return scd2.scd2_history(several, HISTORY, F.lit(True))


@query
def scd2_version_counts(w: Warehouse) -> DataFrame:
    return scd2.scd2_version_counts(w.dim_history, HISTORY)


@query
def scd2_one_current(w: Warehouse) -> DataFrame:
    """Passengers without exactly one current version, once on the good
    dimension and once where the versions opened by the feed are left out."""
    good = scd2.scd2_not_one_current(w.dim_history, HISTORY)
    cut = scd2.scd2_not_one_current(w.applied.kept, HISTORY)
    return good.withColumn("dimension", F.lit("applied")).unionByName(
        cut.withColumn("dimension", F.lit("without opened versions"))
    )


@query
def scd2_no_overlap(w: Warehouse) -> DataFrame:
    """Broken validity chains, in the dimension and in one damaged on purpose:
    closed versions of odd ids end ten days late, those of even ids early."""
    shift = F.when(F.col("passenger_id") % 2 == 1, 10).otherwise(-10)
    end = F.when(F.col("is_current"), F.col("effective_to")).otherwise(
        F.date_add("effective_to", shift)
    )
    damaged = w.dim_history.withColumn("effective_to", end)
    good = scd2.scd2_broken_chains(w.dim_history, HISTORY)
    bad = scd2.scd2_broken_chains(damaged, HISTORY)
    return (
        good.withColumn("dimension", F.lit("applied"))
        .unionByName(bad.withColumn("dimension", F.lit("damaged")))
        .withColumns(_long("span_days", "covered_days"))
    )


@query
def scd2_check(w: Warehouse) -> DataFrame:
    """All invariants, on the good dimension and where the opened versions are left out."""
    good = scd2.scd2_check(w.dim_history, HISTORY, w.load.fact)
    cut = scd2.scd2_check(w.applied.kept, HISTORY, w.load.fact)
    return good.withColumn("dimension", F.lit("applied")).unionByName(
        cut.withColumn("dimension", F.lit("without opened versions"))
    )


@query
def scd2_fact_orphans(w: Warehouse) -> DataFrame:
    """Fact rows whose passenger key the dimension with history lacks."""
    n = checks.orphan_rows(w.load.fact, "passenger_key", w.dim_history, "passenger_key")
    return n.select(F.col("n").alias("orphan_fact_rows"))


def _store(w: Warehouse) -> HistoryStore:
    """A stored dimension that holds the first load."""
    store = HistoryStore(w.spark, f"passenger_{new_path(w.spark, 'x')[-8:]}", HISTORY)
    store.create(w.initial_history)
    return store


def _versions(store: HistoryStore) -> DataFrame:
    """All versions; their keys depend on the order in which the feeds came."""
    return store.read().drop("passenger_key")


@query
def scd2_stored_days(w: Warehouse) -> DataFrame:
    """The stored dimension after three feeds, two of them of one day."""
    store = _store(w)
    store.apply(w.feed(w.late_updates), LATE_DAY)
    store.apply(w.feed(w.updates), AS_OF)
    store.apply(w.feed(w.later_updates), AS_OF)
    return _versions(store)


@query
def scd2_late_day(w: Warehouse) -> DataFrame:
    """Three days of feeds, the first of which comes last."""
    store = _store(w)
    store.apply(w.feed(w.updates), AS_OF)
    store.apply(w.feed(w.later_updates), LATER_DAY)
    store.apply(w.feed(w.late_updates), LATE_DAY)
    return _versions(store)


# -- facts day by day ------------------------------------------------------------


def _daily_fact(w: Warehouse) -> tuple[FactStore, HistoryStore]:
    """Bookings loaded before and after a day's changes, then the changes of a late day."""
    history = _store(w)
    facts = FactStore(w.spark, f"fact_{new_path(w.spark, 'x')[-8:]}", TICKET_SALES, "travel_date_key")
    passenger = next(p for p in TICKET_SALES.parents if p.dimension == "passenger")

    def load(rows: DataFrame, day: date) -> None:
        dims = {**w.dims, "passenger": history.read()}
        facts.add(load_fact_asof(rows, TICKET_SALES, dims, {"passenger": (HISTORY, "booking_date")}).fact, day)

    def change(updates: DataFrame, day: date) -> None:
        done = history.apply(w.feed(updates), day)
        facts.repoint(done.replaced, history.read(), HISTORY, passenger, "booking_date_key", since=day)

    load(w.bookings.where(F.col("booking_date") < F.lit(AS_OF)), AS_OF - timedelta(1))
    change(w.updates, AS_OF)
    load(w.bookings.where(F.col("booking_date") >= F.lit(AS_OF)), AS_OF)
    change(w.late_updates, LATE_DAY)
    return facts, history


@query
def asof_incremental_load(w: Warehouse) -> DataFrame:
    """Every booking with the version it points at after days and a late day."""
    facts, history = _daily_fact(w)
    take = {c: c for c in ("passenger_id", "effective_from", "frequent_flyer_tier", "home_airport_key")}
    found = lookup(facts.read(), history.read(), {"passenger_key": "passenger_key"}, take, "left")
    return found.select("booking_id", F.col("travel_month").cast("long"), *take)


@query
def fact_changed_months(w: Warehouse) -> DataFrame:
    """Months written again when the bookings of one fare class cost more from a month on."""
    fact = w.load.fact
    facts = FactStore(w.spark, f"fact_{new_path(w.spark, 'x')[-8:]}", TICKET_SALES, "travel_date_key")
    facts.rebuild(fact)
    dearer = (F.col("fare_class") == "1-URGENT") & (F.col("travel_date_key") >= LOW)
    fare = (F.col("fare_amount") + F.when(dearer, 1).otherwise(0)).cast("decimal(18,2)")
    written = facts.rebuild(fact.withColumn("fare_amount", fare))
    months = facts.months().withColumn("written", F.col("travel_month").isin(written))
    sums = facts.read().groupBy("travel_month").agg(F.sum("fare_amount").alias("total_fare"))
    return _money(months.join(sums, "travel_month"), "total_fare").withColumns(_long("travel_month"))


# -- partitions ------------------------------------------------------------------


@query
def month_boundaries(w: Warehouse) -> DataFrame:
    keys = partitions.month_boundaries(w.lines, "travel_date")
    return keys.withColumns(_long("boundary_id", "boundary_key"))


@query
def range_partition_number(w: Warehouse) -> DataFrame:
    boundaries = partitions.boundary_keys(w.lines, "travel_date")
    number = partitions.range_partition(F.col("travel_date_key"), boundaries[1:-2])
    return w.lines.select(
        "booking_id",
        "line_number",
        F.col("travel_date_key").cast("long"),
        number.cast("long").alias("partition_number"),
    )


@query
def sales_by_travel_range(w: Warehouse) -> DataFrame:
    return partitions.range_total(partitions.pruned_range(w.line_fact, LOW, HIGH), "fare_amount")


@query
def sales_by_status_class(w: Warehouse) -> DataFrame:
    rows = w.line_fact.where("booking_status = 'F' and fare_class = 'R'")
    return partitions.range_total(rows, "fare_amount")


@query
def partitions_touched(w: Warehouse) -> DataFrame:
    """Month partitions read by the range query and by the status query."""
    ranged = partitions.partitions_read(
        w.line_fact, "travel range", partitions.month_range(LOW, HIGH)
    )
    return ranged.unionByName(partitions.partitions_read(w.line_fact, "status and class"))


# -- rollups ---------------------------------------------------------------------

LINE_SALES = Fact(
    "line_sales",
    ["booking_id", "line_number"],
    (),
    [],
    measures=(Measure("total_fare", "fare_amount"), Measure("total_miles", "miles_earned")),
    ratios=(Ratio("average_fare", "total_fare"), Ratio("fare_by_mile", "total_fare", "total_miles")),
)


@query
def additive_rollup_month(w: Warehouse) -> DataFrame:
    months = w.load.fact.withColumn("travel_month", month_of(F.col("travel_date_key")).cast("long"))
    names = ["total_fare", "total_tax", "total_miles"]
    totals = rollup(months, TICKET_SALES, ["travel_month"], names)
    return _money(totals, "total_fare", "total_tax").withColumns(_long("total_miles"))


@query
def additive_rollup_route(w: Warehouse) -> DataFrame:
    totals = rollup(
        _routes(w), LINE_SALES, ["origin_nation", "dest_nation"], ["total_fare", "total_miles"]
    )
    return _money(totals, "total_fare").withColumns(
        _long("origin_nation", "dest_nation", "total_miles")
    )


@query
def ratio_rollup(w: Warehouse) -> DataFrame:
    months = w.lines.withColumn("travel_month", month_of(F.col("travel_date_key")).cast("long"))
    return rollup(months, LINE_SALES, ["travel_month"], ["average_fare", "fare_by_mile"])


# -- verification ----------------------------------------------------------------


@query
def grain_check(w: Warehouse) -> DataFrame:
    return checks.grain_check(w.lines, ["booking_id", "line_number"])


@query
def functional_dependency(w: Warehouse) -> DataFrame:
    """Countries with several regions, and cities named in several countries."""
    found = [
        checks.functional_dependency(w.geography, [of], to).select(
            F.lit(f"{of} to {to}").alias("dependency"), F.col(of).alias("determinant"), "values"
        )
        for of, to in (("country", "region"), ("city", "country"))
    ]
    return found[0].unionByName(found[1])


@query
def date_range_profile(w: Warehouse) -> DataFrame:
    """The landed bookings' days, from their files' footers."""
    days = "booking_date", "travel_date"
    row = footers.date_ranges(w.spark, w.bookings_path, w.bookings.schema, *days)
    return checks.ranges_of(row, *days)


@query
def constraint_report(w: Warehouse) -> DataFrame:
    """Keys, references, NOT NULL and lengths of the history and of the lines."""
    history = checks.constraint_report(
        w.dim_history,
        [
            checks.Unique("passenger_key primary key", ("passenger_key",)),
            checks.Unique("passenger_id unique", ("passenger_id",)),
            checks.Unique("one current version", ("passenger_id",), F.col("is_current")),
            checks.Reference(
                "home airport exists", "home_airport_key", w.dim_airport, "airport_key"
            ),
            *checks.not_null("passenger", *HISTORY.columns),
            *checks.max_length("passenger", {"passenger_name": 20, "frequent_flyer_tier": 20}),
        ],
    )
    lines = checks.constraint_report(
        w.lines,
        [
            checks.Unique("line primary key", ("booking_id", "line_number")),
            checks.Unique(
                "travel date and booking", ("travel_date_key", "booking_id", "line_number")
            ),
            checks.Reference("flight exists", "flight_id", w.flights, "flight_id"),
            *checks.not_null("line", "travel_date", "fare_amount"),
        ],
    )
    return history.unionByName(lines)


# -- contract --------------------------------------------------------------------


def _raw_bookings(w: Warehouse) -> DataFrame:
    """Events delivered as a booking feed, all text, some of it no value of its type."""
    return w.table("events").select(
        F.col("event_id").cast("string").alias("booking_id"),
        F.col("props").alias("passenger_id"),
        F.get_json_object("props", "$.k").alias("flight_id"),
        F.col("ts").cast("date").cast("string").alias("booking_date"),
        F.col("event_type").alias("travel_date"),
        F.col("event_type").alias("fare_class"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("fare_amount"),
        F.concat("event_type", F.lit("")).alias("booking_status"),
        F.get_json_object("props", "$.k").alias("miles_earned"),
        F.col("user_id").cast("string").alias("payment_method"),
    )


@query
def contract_types(w: Warehouse) -> DataFrame:
    return rules.check_types(_raw_bookings(w), BOOKING_CONTRACT)


@query
def contract_csv_types(w: Warehouse) -> DataFrame:
    """The same check on a delivered CSV file."""
    path = new_path(w.spark, "raw-csv")
    _raw_bookings(w).write.option("header", True).csv(path)
    return rules.check_types(read_text_columns(w.spark, path), BOOKING_CONTRACT)


def _text_bookings(w: Warehouse) -> DataFrame:
    """Bookings as text, some with a value that their column's type does not hold."""
    n = F.col("booking_id")
    text = w.bookings.select(*[F.col(c).cast("string").alias(c) for c in BOOKING_CONTRACT.names], n.alias("n"))
    damaged = {
        "passenger_id": F.when(F.col("n") % 13 == 0, F.concat(F.lit("P"), "passenger_id")),
        "booking_date": F.when(F.col("n") % 11 == 0, F.regexp_replace("booking_date", "-", "/")),
        "fare_amount": F.when(F.col("n") % 7 == 0, F.concat("fare_amount", F.lit("9"))),
        "miles_earned": F.when(F.col("n") % 17 == 0, F.lit("none")),
    }
    text = text.withColumns({c: F.coalesce(bad, F.col(c)) for c, bad in damaged.items()})
    return text.withColumn("booking_id", F.concat(F.lit(" "), "booking_id", F.lit(" "))).drop("n")


@query
def contract_typed_quarantine(w: Warehouse) -> DataFrame:
    """Every booking delivered as text: typed, or set aside with all its reasons."""
    typed, wrong = rules.conform(_text_bookings(w), BOOKING_CONTRACT)
    columns = ["passenger_id", "booking_date", "fare_amount", "miles_earned"]
    good = typed.select("booking_id", F.lit("").alias("reasons"), *[F.col(c).cast("string") for c in columns])
    number = F.trim("booking_id").cast("long").alias("booking_id")
    return good.unionByName(wrong.select(number, F.array_join("reasons", "; ").alias("reasons"), *columns))


@query
def batch_profile(w: Warehouse) -> DataFrame:
    """The bookings' profile, merged from those of the bookings with and without a flight."""
    parts = [w.bookings.where(c) for c in ("flight_id IS NOT NULL", "flight_id IS NULL")]
    return profile.merge_profiles(*[profile.batch_profile(p, BOOKING_CONTRACT) for p in parts])


@query
def drift_profile(w: Warehouse) -> DataFrame:
    """The drift of ``contract_drift`` from two stored profiles."""
    kept = [stage(profile.batch_profile(b, BOOKING_CONTRACT), "profile") for b in (w.bookings, _changed(w))]
    return profile.profile_drift(*kept, BOOKING_CONTRACT)


@query
def volume_gate(w: Warehouse) -> DataFrame:
    """Verdicts on batches by their profiles: the first, a fall, a rise, an empty one."""
    whole, flown, none = (
        stage(profile.batch_profile(b), "profile")
        for b in (w.bookings, w.bookings.where("flight_id IS NOT NULL"), w.bookings.where(F.lit(False)))
    )
    cases = {"first": (whole, None), "fall": (flown, whole), "rise": (whole, flown), "empty": (none, whole)}
    found = [profile.profile_volume(*pair).withColumn("case", F.lit(name)) for name, pair in cases.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query
def freshness_gate(w: Warehouse) -> DataFrame:
    """Feeds that hold up each day, and whether the day may run."""
    first, last = _delivery_days(w)
    report = rules.freshness(w.arrivals, rules.expected_days(w.arrivals, first, last + timedelta(1)))
    return report.groupBy("business_date").agg(
        F.count(F.lit(1)).alias("feeds"),
        F.count_if("paused").alias("waiting"),
        (F.count_if("paused") == 0).alias("may_run"),
    )


@query
def contract_notnull(w: Warehouse) -> DataFrame:
    return rules.check_rules(w.bookings, rules.not_null_rules(BOOKING_CONTRACT))


@query
def contract_domain(w: Warehouse) -> DataFrame:
    return rules.check_rules(w.bookings, rules.domain_rules(BOOKING_CONTRACT))


@query
def contract_ranges(w: Warehouse) -> DataFrame:
    return rules.check_rules(w.bookings, rules.range_rules(BOOKING_CONTRACT))


@query
def contract_date_order(w: Warehouse) -> DataFrame:
    """Lines shipped before their order was placed."""
    return rules.check_cross_table(
        w.lines,
        w.table("orders"),
        {"booking_id": "o_orderkey"},
        {"o_orderdate": "ordered"},
        F.col("ordered").cast("date") > F.col("travel_date"),
        large=True,
    )


@query
def contract_cross_table(w: Warehouse) -> DataFrame:
    """Bookings that travel on another day than their flight."""
    return rules.check_cross_table(
        w.bookings,
        w.flights,
        {"flight_id": "flight_id"},
        {"flight_date": "flight_date"},
        F.col("travel_date") != F.col("flight_date"),
    )


@query
def contract_unique(w: Warehouse) -> DataFrame:
    """Repeated booking numbers, where every line delivers its booking again."""
    return rules.check_unique(w.lines, BOOKING_CONTRACT)


@query
def contract_fk(w: Warehouse) -> DataFrame:
    """References into parents that lack the passengers of one tier and one aircraft."""
    parents = {
        "passengers": w.passengers.where("frequent_flyer_tier <> 'BUILDING'"),
        "flights": w.flights.where("aircraft_code <> 'BRAND#12'"),
    }
    return rules.check_references(w.bookings, BOOKING_CONTRACT, parents)


@query
def contract_quarantine(w: Warehouse) -> DataFrame:
    """Every booking the contract sets aside, with its reasons."""
    verdict = _verdict(w)
    return verdict.quarantined.select("booking_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def contract_accepted(w: Warehouse) -> DataFrame:
    return _verdict(w).accepted


@query
def contract_alerts(w: Warehouse) -> DataFrame:
    return _verdict(w).alerts


def _verdict(w: Warehouse) -> rules.Verdict:
    parents = {"passengers": w.passengers, "flights": w.flights}
    return rules.apply_contract(w.bookings, BOOKING_CONTRACT, parents)


@query
def contract_freshness(w: Warehouse) -> DataFrame:
    """Deliveries of every user on every day up to the day after the last, on which none came."""
    first, last = _delivery_days(w)
    return rules.freshness(w.arrivals, rules.expected_days(w.arrivals, first, last + timedelta(1)))


def _delivery_days(w: Warehouse) -> tuple[date, date]:
    return w.arrivals.agg(F.min("business_date"), F.max("business_date")).first()


@query
def contract_volume(w: Warehouse) -> DataFrame:
    """All bookings against those with a flight, as falling and as growing snapshots."""
    everything, flown = w.bookings, w.bookings.where("flight_id is not null")
    falling = rules.volume_check(flown, everything).withColumn("case", F.lit("falling"))
    growing = rules.volume_check(everything, flown).withColumn("case", F.lit("growing"))
    return falling.unionByName(growing)


@query
def contract_volume_by_day(w: Warehouse) -> DataFrame:
    """Every day's deliveries, also of days before the first and after the last."""
    first, last = _delivery_days(w)
    return rules.volume_by_day(w.arrivals, "business_date", first - timedelta(2), last + timedelta(2))


@query
def dim_rejects(w: Warehouse) -> DataFrame:
    """Passengers whose home airport one region's airports do not hold."""
    known = w.dim_airport.where("airport_key % 5 <> 0")
    found = split_dim(w.passengers, PASSENGER, {"airport": known})
    return found.rejects.select("passenger_id", F.array_join("reasons", ", ").alias("reason"))


@query
def narrowing_report(w: Warehouse) -> DataFrame:
    """Aircraft against declared types; some seat capacities and codes do not fit theirs."""
    n = F.col("seat_capacity")
    feed = w.aircraft.withColumn("seat_capacity", F.when(n % 2 == 0, n + 2**40).otherwise(n))
    types = {"aircraft_code": "char(8)", "model": "varchar(6)", "manufacturer": "varchar(6)", "seat_capacity": "int"}
    rows, rejects = split_dim(feed, replace(AIRCRAFT, types=types), {})
    kept = rows.select("aircraft_code", F.lit("").alias("reasons"), "seat_capacity")
    lost = rejects.select("aircraft_code", F.array_join("reasons", "; ").alias("reasons"), F.lit(None).cast("int").alias("seat_capacity"))
    return kept.unionByName(lost)


@query
def contract_cross_quarantine(w: Warehouse) -> DataFrame:
    """Bookings set aside because they travel on another day than their flight."""
    rule = rules.CrossRule(
        "travel date is not the flight's",
        "flights",
        {"flight_id": "flight_id"},
        {"flight_date": "flight_date"},
        "travel_date <> flight_date",
    )
    contract = rules.Contract(BOOKING_CONTRACT.columns[:1], cross_rules=(rule,))
    verdict = rules.apply_contract(w.bookings, contract, {"flights": w.flights})
    return verdict.quarantined.select("booking_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def contract_new_values(w: Warehouse) -> DataFrame:
    return rules.new_values(w.bookings, BOOKING_CONTRACT)


@query
def contract_drift(w: Warehouse) -> DataFrame:
    """A batch that renames a column, retypes one and adds one."""
    return rules.classify_drift(w.bookings, _changed(w), BOOKING_CONTRACT)


def _changed(w: Warehouse) -> DataFrame:
    return w.bookings.select(
        *[F.col(c) for c in BOOKING_CONTRACT.names if c not in ("booking_status", "fare_amount")],
        F.col("booking_status").alias("status"),
        F.col("fare_amount").cast("float"),
        F.lit(None).cast("string").alias("payment_method"),
    )


@query
def extra_column_ignored(w: Warehouse) -> DataFrame:
    wider = w.bookings.withColumn("payment_method", F.lit("card"))
    return rules.named_columns(wider, BOOKING_CONTRACT)


# -- daily feeds as streams ------------------------------------------------------


@query
def stream_feed_ingest(w: Warehouse) -> DataFrame:
    """Bookings delivered as CSV files and taken in by a stream."""
    source = new_path(w.spark, "feed")
    w.bookings.write.option("header", True).csv(source)
    target, log = new_path(w.spark, "bronze"), new_path(w.spark, "ingest-log")
    return feeds.ingest(w.spark, source, w.bookings.schema, target, log).rows


@query
def stream_scd2_apply(w: Warehouse) -> DataFrame:
    """The change feed applied by a stream; the same dimension as in one batch."""
    source = new_path(w.spark, "updates")
    w.updates.withColumn("feed_date", F.lit(AS_OF)).write.option("header", True).csv(source)
    store = _store(w)
    _stream(w, store, source)
    return store.read()


def _stream(w: Warehouse, store: HistoryStore, source: str) -> feeds.DeadLetters:
    return feeds.apply_feed(
        w.spark,
        source,
        w.updates.schema,
        store,
        PASSENGER.parents,
        {"airport": w.dim_airport},
        checkpoint=new_path(w.spark, "apply-log"),
        rejects=new_path(w.spark, "apply-rejects"),
    )


def _refused(w: Warehouse) -> tuple[HistoryStore, feeds.DeadLetters]:
    """A stream of four days: one names new passengers twice, one lies before the first load."""
    source = new_path(w.spark, "updates")
    twice = w.late_updates.unionByName(w.late_updates.where("passenger_id % 3 = 0"))
    days = {date(1990, 1, 1): w.later_updates, LATE_DAY: twice, AS_OF: w.updates, LATER_DAY: w.later_updates}
    for day, rows in days.items():
        rows.withColumn("feed_date", F.lit(day)).write.mode("append").option("header", True).csv(source)
    store = _store(w)
    return store, _stream(w, store, source)


@query
def stream_dead_letters(w: Warehouse) -> DataFrame:
    """Days that the stored dimension refused; the stream took in the others."""
    store, dead = _refused(w)
    days = store.feeds().groupBy("feed_day").count().select(
        F.col("feed_day").alias("feed_date"), F.lit("applied").alias("outcome"), F.col("count").alias("rows")
    )
    refused = dead.report().select("feed_date", F.col("reason").alias("outcome"), "rows")
    return days.unionByName(refused)


@query
def stream_replayed(w: Warehouse) -> DataFrame:
    """The dimension after the refused days came again, each passenger once."""
    store, dead = _refused(w)
    dead.replay(lambda rows: rows.dropDuplicates(["passenger_id"]))
    return _versions(store)


# -- flagship --------------------------------------------------------------------


@query
def month_sales_through_dims(w: Warehouse) -> DataFrame:
    """Bookings and fare per tier of the passengers who travelled in one month."""
    rows = partitions.pruned_range(w.booking_fact, LOW, HIGH)
    tiers = lookup(
        rows, w.dim_passenger, {"passenger_key": "passenger_key"}, {"frequent_flyer_tier": "tier"}
    )
    totals = tiers.groupBy("tier").agg(
        F.count(F.lit(1)).alias("bookings"), F.sum("fare_amount").alias("total_fare")
    )
    return _money(totals, "total_fare")


