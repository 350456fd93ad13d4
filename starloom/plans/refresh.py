"""The daily refresh: bronze as delivered, silver dimensions, gold fact.

Each step writes a new version, checks it, and shows it. A step that fails leaves
what was shown before, and every step can run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.model import Dimension, Fact, History
from starloom.operators.checks import orphan_check, reconcile
from starloom.operators.contract import Contract, Verdict, apply_contract
from starloom.operators.dims import calendar_dim, split_dim
from starloom.operators.facts import load_fact, load_fact_asof
from starloom.operators.joins import lookup
from starloom.operators.keys import assign_keys
from starloom.operators.profile import batch_profile, profile_drift, profile_volume
from starloom.session import stage
from starloom.sources.facts import FactStore
from starloom.sources.sinks import replace_table


class RefreshStopped(RuntimeError):
    """A check failed; what was shown before is still shown."""


@dataclass(frozen=True)
class Layers:
    """Names of the three layers' databases."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"


def land(spark: SparkSession, layers: Layers, feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Store the day's feeds as delivered."""
    return {name: replace_table(df, f"{layers.bronze}.{name}") for name, df in feeds.items()}


def gate_freshness(report: DataFrame, day: date) -> None:
    """Stop when a feed the day needs has not landed in time, or the report lacks the day."""
    of_day = report.where(F.col("business_date") == F.lit(day))
    counts = of_day.agg(
        F.count(F.lit(1)).alias("feeds"), F.count_if("paused").alias("waiting")
    ).first()
    if counts["feeds"] == 0:
        raise RefreshStopped(f"nothing is known of the deliveries on {day}")
    if counts["waiting"]:
        some = of_day.where("paused").select("feed").orderBy("feed").limit(20).collect()
        names = ", ".join(r["feed"] for r in some)
        more = " and others" if counts["waiting"] > len(some) else ""
        raise RefreshStopped(
            f"{counts['waiting']} feeds not delivered in time on {day}: {names}{more}"
        )


def gate_batch(
    name: str, profile: DataFrame, accepted: DataFrame | None, contract: Contract | None = None
) -> None:
    """Stop when a batch is empty, lost more rows than allowed, or changed its columns.

    ``profile`` is the batch's, ``accepted`` that of the last batch whose day went
    through: a batch that was turned down is nothing to compare with. A new value of a
    closed list is no reason to stop: the contract sets such rows aside.
    """
    columns = {r["column_name"] for r in profile.where("kind = 'column'").select("column_name").collect()}
    absent = [c for c in contract.names if c not in columns] if contract else []
    if absent:
        raise RefreshStopped(f"{name}: no column {', '.join(absent)}")
    if accepted is not None:
        broken = profile_drift(accepted, profile).where("breaking").orderBy("column_name").collect()
        if broken:
            found = [f"{r['change']} {r['column_name']} ({r['detail']})" for r in broken]
            raise RefreshStopped(f"{name}: {'; '.join(found)}")
    volume = profile_volume(profile, accepted).first()
    if volume["status"] in ("alert", "missing"):
        raise RefreshStopped(f"{name}: {volume['prior_rows'] or 0} rows, now {volume['today_rows']}")


def accept(
    layers: Layers,
    name: str,
    batch: DataFrame,
    contract: Contract,
    parents: dict[str, DataFrame],
    mode: str = "quarantine",
) -> DataFrame:
    """Split a batch by its contract and keep what was set aside, with the alerts.

    In mode ``reject`` a batch with a broken rule is set aside whole, and the day stops.
    """
    verdict: Verdict = apply_contract(batch, contract, parents, mode)
    replace_table(verdict.quarantined, f"{layers.bronze}.{name}_quarantine")
    shown = replace_table(verdict.alerts, f"{layers.bronze}.{name}_alerts")
    if mode == "reject" and not shown.isEmpty():
        raise RefreshStopped(f"{name}: the batch breaks its contract, see {layers.bronze}.{name}_alerts")
    return verdict.accepted


def refresh_calendar(spark: SparkSession, layers: Layers, start: date, end: date) -> DataFrame:
    return replace_table(calendar_dim(spark, start, end), f"{layers.silver}.dim_date")


def refresh_dimension(
    spark: SparkSession, layers: Layers, src: DataFrame, spec: Dimension, parents: dict[str, DataFrame]
) -> DataFrame:
    """Full refresh of a dimension, with the rows that found no parent kept as rejects.

    A registry holds every surrogate ever given. It is written before the dimension is
    shown, so a key is not given twice, even after its member left or a load died.
    """
    table, given = f"{layers.silver}.dim_{spec.name}", f"{layers.silver}.keys_{spec.name}"
    known = spark.table(given) if spark.catalog.tableExists(given) else None
    found = split_dim(src, spec, parents)
    rejects = replace_table(found.rejects, f"{layers.silver}.rejects_{spec.name}")
    built = stage(assign_keys(found.rows, spec.business_key, spec.key, known), spec.name)
    keys = built.select(spec.key, *spec.business_key)
    if known is not None:
        gone = lookup(known, keys, {spec.key: spec.key}, how="left_anti", unique=True)
        keys = keys.unionByName(gone.select(*keys.columns))
    replace_table(keys, given)
    gap = reconcile(src, built).first()["gap"]
    if gap != rejects.count():
        raise RefreshStopped(f"{table}: {gap} rows missing, {rejects.count()} rejected")
    return replace_table(built, table)


def rebuild_fact(
    spark: SparkSession,
    layers: Layers,
    bookings: DataFrame,
    spec: Fact,
    dims: dict[str, DataFrame],
    key: str = "travel_date_key",
    history: dict[str, tuple[History, str]] | None = None,
) -> DataFrame:
    """Load the fact, verify it, write the months that changed, show them.

    ``history`` names the dimensions that are resolved as of a date of the booking.
    """
    table = f"{layers.gold}.fact_{spec.name}"
    fact, rejects = load_fact_asof(bookings, spec, dims, history) if history else load_fact(bookings, spec, dims)
    gap, lost = reconcile(bookings, fact).first()["gap"], rejects.count()
    if gap != lost:
        raise RefreshStopped(f"{table}: {gap} rows missing, {lost} rejected")
    references = {p.result: (p.result, dims[p.dimension], p.key) for p in spec.parents}
    orphaned = {n: c for n, c in orphan_check(fact, references).first().asDict().items() if c}
    if orphaned:
        raise RefreshStopped(f"{table}: {orphaned}")
    replace_table(rejects, f"{layers.gold}.rejects_{spec.name}")
    store = FactStore(spark, table, spec, key)
    store.rebuild(fact)
    return store.read()


@dataclass(frozen=True)
class Inputs:
    """What a day's feeds came to: dimensions, accepted bookings, profiles to keep."""

    dims: dict[str, DataFrame]
    bookings: DataFrame
    profiles: dict[str, DataFrame]


def refresh_inputs(
    spark: SparkSession,
    layers: Layers,
    feeds: dict[str, DataFrame],
    contract: Contract,
    dimensions: list[Dimension],
    calendar: tuple[date, date],
    deliveries: tuple[DataFrame, date],
    mode: str = "quarantine",
) -> Inputs:
    """Gates, bronze, dimensions and the bookings that keep their contract.

    ``feeds`` holds ``bookings`` and one feed per dimension under its name;
    ``dimensions`` lists parents before the dimensions that refer to them.
    ``deliveries`` is a freshness report and the day it must allow.
    """
    gate_freshness(*deliveries)
    profiles = {}
    for name, batch in feeds.items():
        rules, kept = contract if name == "bookings" else None, f"{layers.bronze}.{name}_profile"
        profiles[name] = stage(batch_profile(batch, rules), f"profile-{name}")
        gate_batch(name, profiles[name], spark.table(kept) if spark.catalog.tableExists(kept) else None, rules)
    landed = land(spark, layers, feeds)
    dims: dict[str, DataFrame] = {"date": refresh_calendar(spark, layers, *calendar)}
    for spec in dimensions:
        dims[spec.name] = refresh_dimension(spark, layers, landed[spec.name], spec, dims)
    needed = {x.parent for x in (*contract.references, *contract.cross_rules)}
    parents = {name: landed[name] for name in needed}
    return Inputs(dims, accept(layers, "bookings", landed["bookings"], contract, parents, mode), profiles)


def keep_profiles(layers: Layers, inputs: Inputs) -> None:
    """Make the day's batches those that the next day is compared with."""
    for name, profile in inputs.profiles.items():
        replace_table(profile, f"{layers.bronze}.{name}_profile")


def refresh(
    spark: SparkSession,
    layers: Layers,
    feeds: dict[str, DataFrame],
    contract: Contract,
    dimensions: list[Dimension],
    fact: Fact,
    calendar: tuple[date, date],
    deliveries: tuple[DataFrame, date],
    mode: str = "quarantine",
) -> DataFrame:
    """One whole day: feeds in, fact out (see ``refresh_inputs``)."""
    inputs = refresh_inputs(spark, layers, feeds, contract, dimensions, calendar, deliveries, mode)
    done = rebuild_fact(spark, layers, inputs.bookings, fact, inputs.dims)
    keep_profiles(layers, inputs)
    return done
