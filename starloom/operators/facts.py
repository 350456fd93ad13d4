"""Fact loads: every foreign key resolved, nothing dropped in silence."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Row, functions as F

from starloom.functions.columns import all_of, failed_names, narrow_int
from starloom.model import Fact, History
from starloom.operators.dims import resolve_parents
from starloom.operators.joins import lookup
from starloom.session import setting, stage

#: Versions of one key that each of its rows may meet.
VERSIONS_PER_KEY = 32


class Load(NamedTuple):
    fact: DataFrame
    rejects: DataFrame


def resolve_fact(src: DataFrame, spec: Fact, dims: dict[str, DataFrame]) -> DataFrame:
    """All source rows with their keys and the roles that found no parent."""
    resolved = resolve_parents(src, spec.parents, dims, "left")
    return _judged(resolved, spec)


def _judged(resolved: DataFrame, spec: Fact) -> DataFrame:
    missing = {f"no {p.role}": F.col(p.result).isNull() for p in spec.parents}
    return resolved.withColumn("reasons", failed_names(missing)).withColumn(
        "rejected", F.size("reasons") > 0
    )


def split_load(resolved: DataFrame, spec: Fact) -> Load:
    """The fact rows and the rejected source rows of a resolved frame."""
    keys = [p.result for p in spec.parents]
    columns = [narrow_int(F.col(c)).alias(c) if c in spec.narrow else F.col(c) for c in spec.columns]
    found = resolved.where(~F.col("rejected")).where(all_of(F.col(k).isNotNull() for k in keys))
    rejects = resolved.where("rejected")
    return Load(found.select(*spec.grain, *keys, *columns), rejects.select(*spec.grain, "reasons"))


def load_fact(src: DataFrame, spec: Fact, dims: dict[str, DataFrame]) -> Load:
    """Fact and rejects, written in one pass with the rejects apart."""
    return split_load(stage(resolve_fact(src, spec, dims), spec.name, "rejected"), spec)


def asof_lookup(
    src: DataFrame,
    dim: DataFrame,
    spec: History,
    on: dict[str, str],
    day: str,
    take: dict[str, str],
    how: str = "left",
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """The version valid on each row's ``day``: from ``<= day <`` to.

    A key has at most one version per day. Where a key has many, versions are split
    by the years they cover, so a row meets those of its year only. Where no key
    does, that would only multiply the versions.
    """
    begin, end = spec.validity
    taken = {**take, begin: "__from", end: "__to"}
    within = (F.col(day) >= F.col("__from")) & (F.col(day) < F.col("__to"))
    days = src if keys_of is None else keys_of
    if _most_versions(dim, list(on.values())) <= setting(src.sparkSession, "versionsPerKey", VERSIONS_PER_KEY):
        return lookup(src, dim, on, taken, how, within, days).drop("__from", "__to")
    versions = _by_year(dim, spec, days.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first())
    year = F.trunc(day, "year")
    joined = lookup(
        src.withColumn("__year", year),
        versions,
        {**on, "__year": "__year"},
        taken,
        how,
        within,
        days.withColumn("__year", year),
    )
    return joined.drop("__from", "__to", "__year")


def _most_versions(dim: DataFrame, keys: list[str]) -> int:
    return dim.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def _by_year(dim: DataFrame, spec: History, days: Row) -> DataFrame:
    """Each version once per year it shares with the range of fact dates."""
    begin, end = spec.validity
    if days["lo"] is None:
        return dim.where(F.lit(False)).withColumn("__year", F.trunc(begin, "year"))
    low = F.greatest(F.col(begin), F.lit(days["lo"]))
    high = F.least(F.date_sub(end, 1), F.lit(days["hi"]))
    years = F.sequence(F.trunc(low, "year"), F.trunc(high, "year"), F.expr("interval 1 year"))
    return dim.where(low <= high).withColumn("__year", F.explode(years))


def load_fact_asof(
    src: DataFrame, spec: Fact, dims: dict[str, DataFrame], history: dict[str, tuple[History, str]]
) -> Load:
    """Like ``load_fact``, with some dimensions resolved as of a source date.

    ``history`` names them and gives each its version columns and date column.
    """
    plain = tuple(p for p in spec.parents if p.dimension not in history)
    resolved = resolve_parents(src, plain, dims, "left")
    for parent in spec.parents:
        if parent.dimension in history:
            versions, day = history[parent.dimension]
            take = {parent.key: parent.result}
            dim = dims[parent.dimension]
            resolved = asof_lookup(resolved, dim, versions, parent.on, day, take, keys_of=src)
    return split_load(stage(_judged(resolved, spec), spec.name, "rejected"), spec)
