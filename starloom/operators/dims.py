"""Calendar, conformed dimensions and their snowflakes."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.columns import any_of, as_declared, failed_names, misfits
from starloom.functions.dates import calendar_columns
from starloom.model import Dimension, Level, Parent
from starloom.operators.joins import lookup
from starloom.operators.keys import assign_keys, number_rows
from starloom.session import stage


def calendar_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return _days(bounds)


def calendar_for(df: DataFrame, *dates: str) -> DataFrame:
    """The calendar covering every date found in ``dates``."""
    lows = [F.min(c) for c in dates]
    highs = [F.max(c) for c in dates]
    if len(dates) > 1:
        lows, highs = [F.least(*lows)], [F.greatest(*highs)]
    return _days(df.agg(lows[0].alias("first"), highs[0].alias("last")))


def _days(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return days.select(*[c.alias(n) for n, c in calendar_columns(F.col("full_date")).items()])


def resolve_parents(
    src: DataFrame, parents: tuple[Parent, ...], dims: dict[str, DataFrame], how: str
) -> DataFrame:
    """Add each parent's surrogate key under its role's column."""
    resolved = src
    for p in parents:
        take = {p.key: p.result}
        resolved = lookup(resolved, dims[p.dimension], p.on, take, how, keys_of=src)
    return resolved


class DimRows(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _judged(src: DataFrame, spec: Dimension, dims: dict[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    """The dimension's columns with parent keys resolved, and ``reasons`` against each row."""
    resolved = resolve_parents(src, spec.parents, dims, "left")
    named = resolved.select(
        *[F.col(c).alias(n) for c, n in spec.columns.items()],
        *[p.result for p in spec.parents],
    )
    wrong = {f"{c} is null": F.col(c).isNull() for c in spec.business_key}
    wrong |= {f"no {p.role}": F.col(p.result).isNull() for p in spec.parents}
    wrong |= {f"{c} is no {kind}": misfits(F.col(c), kind) for c, kind in spec.types.items()}
    return named.withColumn("reasons", failed_names(wrong)), named.columns


def _typed(rows: DataFrame, spec: Dimension, columns: list[str]) -> DataFrame:
    return rows.select(*[as_declared(F.col(c), spec.types[c]).alias(c) if c in spec.types else c for c in columns])


def split_dim(src: DataFrame, spec: Dimension, dims: dict[str, DataFrame]) -> DimRows:
    """The dimension's rows with parent keys resolved, before its own key, and the rejects.

    A reject has no value for its business key, a role without parent, or a value that is
    none of its declared type. Both are written in one pass.
    """
    marked, columns = _judged(src, spec, dims)
    judged = stage(marked.withColumn("rejected", F.size("reasons") > 0), spec.name, "rejected")
    rows = _typed(judged.where("not rejected"), spec, columns)
    return DimRows(rows, judged.where("rejected").select(*spec.business_key, "reasons"))


def project_dim(src: DataFrame, spec: Dimension, dims: dict[str, DataFrame]) -> DataFrame:
    """The dimension's rows that found their parents, before its own key. Nothing is written."""
    marked, columns = _judged(src, spec, dims)
    return _typed(marked.where(F.size("reasons") == 0), spec, columns)


def build_dim(
    src: DataFrame,
    spec: Dimension,
    dims: dict[str, DataFrame] | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """A keyed dimension. Pass ``existing`` to keep the keys already given."""
    rows = project_dim(src, spec, dims or {})
    return assign_keys(rows, spec.business_key, spec.key, existing)


def snowflake(flat: DataFrame, levels: list[Level], leaf: str) -> dict[str, DataFrame]:
    """Split a flat dimension into a table per level, from the top down.

    A member is known by its own name and the level above together, as a name
    alone may recur. The leaf keeps its key and everything the levels do not
    take, with a reference to the lowest level. A member with several attribute
    values would be ambiguous, and a leaf without a value for a level would be lost,
    so both fail.
    """
    levelled = [c for level in levels for c in level.columns]
    lost = flat.where(any_of(F.col(c).isNull() for c in levelled)).limit(1).collect()
    if lost:
        raise ValueError(f"a leaf lacks one of {', '.join(levelled)}: {lost[0].asDict()}")
    tables: dict[str, DataFrame] = {}
    current, above = flat, []
    for level in levels:
        taken = {**level.columns, **level.attributes}
        members = current.select(*[F.col(c).alias(n) for c, n in taken.items()], *above).distinct()
        name = [*level.columns.values(), *above]
        numbered = number_rows(members, [*name, *level.attributes.values()], level.key)
        twice = numbered.groupBy(*name).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{level.name} {twice[0][0]} has several values of an attribute")
        on = {**level.columns, **{k: k for k in above}}
        current = lookup(current, numbered, on, {level.key: level.key}).drop(*above)
        tables[level.name] = numbered
        above = [level.key]
    moved = [c for level in levels for c in (*level.columns, *level.attributes)]
    tables[leaf] = stage(current.drop(*moved), leaf)
    return tables


def resolve_levels(
    tables: dict[str, DataFrame], levels: list[Level], leaf: str, columns: list[str]
) -> DataFrame:
    """The leaf's ``columns`` with those of every level above, ordered top down."""
    flat = tables[leaf]
    for level, above in zip(reversed(levels), [*reversed(levels[:-1]), None]):
        names = [*level.columns.values(), *level.attributes.values()]
        take = {n: n for n in [*names, *([above.key] if above else [])]}
        flat = lookup(flat, tables[level.name], {level.key: level.key}, take)
    named = [n for level in levels for n in level.columns.values()]
    described = [n for level in levels for n in level.attributes.values()]
    return flat.select(*columns, *named, *described).orderBy(*named, *columns)
