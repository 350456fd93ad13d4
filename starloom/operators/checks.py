"""Verification jobs: counts, keys, references, dependencies, constraints."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.joins import lookup


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def side_by_side(counts: dict[str, DataFrame]) -> DataFrame:
    """Each frame's single ``n`` as one column of a single row."""
    tagged = [df.select(F.lit(name).alias("name"), "n") for name, df in counts.items()]
    return _union(tagged).agg(
        *[F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in counts]
    )


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def row_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            _count(df).select(F.lit(name).alias("table_name"), F.col("n").alias("row_count"))
            for name, df in tables.items()
        ]
    )


def reconcile(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Source and fact row counts with the gap between them."""
    both = side_by_side({"source_rows": _count(source), "fact_rows": _count(fact)})
    return both.withColumn("gap", F.col("source_rows") - F.col("fact_rows"))


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of ``column`` that the parent lacks, with their row counts.

    Rows are counted per value before anything is joined, so a value that most
    rows share costs no more than any other. NULL refers to nothing and is not
    an orphan.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return lookup(values, parent, {column: key}, how="left_anti", unique=True)


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    lost = orphans(child, column, parent, key)
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def orphan_check(
    fact: DataFrame, references: dict[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """Orphan rows per role: ``{role: (fact column, dimension, key)}``.

    The fact is read once: rows are counted per role and value, and only those counts
    meet the keys. A dimension in several roles is read for each.
    """
    held = [
        F.struct(F.lit(role).alias("role"), F.col(column).cast("string").alias("value"))
        for role, (column, _, _) in references.items()
    ]
    counts = (
        fact.select(F.inline(F.array(*held)))
        .where("value IS NOT NULL")
        .groupBy("role", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    keys = _union(
        [
            dim.select(F.lit(role).alias("role"), F.col(key).cast("string").alias("value"))
            for role, (_, dim, key) in references.items()
        ]
    )
    lost = counts.join(keys, ["role", "value"], "left_anti")
    return lost.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("role") == role, F.col("rows"))), F.lit(0)).alias(f"orphan_{role}")
            for role in references
        ]
    )


def grain_check(df: DataFrame, grain: list[str]) -> DataFrame:
    """Grain values that occur more than once."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def functional_dependency(df: DataFrame, determinant: list[str], dependent: str) -> DataFrame:
    """Determinants that go with more than one value of ``dependent``."""
    values = F.count_distinct(F.col(dependent)).alias("values")
    return df.groupBy(*determinant).agg(values).where("values > 1")


def date_range_profile(df: DataFrame, *days: str) -> DataFrame:
    """Earliest and latest value per date column, one row each."""
    return ranges_of(
        df.agg(*[f(F.col(d)).alias(f"{n}_{d}") for d in days for n, f in (("lo", F.min), ("hi", F.max))]), *days
    )


def ranges_of(row: DataFrame, *days: str) -> DataFrame:
    """One row of earliest and latest days as one row per column."""
    ranges = [
        F.struct(
            F.lit(d).alias("column_name"),
            F.col(f"lo_{d}").alias("earliest"),
            F.col(f"hi_{d}").alias("latest"),
        )
        for d in days
    ]
    return row.select(F.inline(F.array(*ranges)))


@dataclass(frozen=True)
class Unique:
    """Unique columns; ``where`` restricts it to a part of the rows."""

    name: str
    columns: tuple[str, ...]
    where: Column | None = None


@dataclass(frozen=True)
class Reference:
    name: str
    column: str
    parent: DataFrame
    key: str


@dataclass(frozen=True)
class RowRule:
    """A condition no row may meet."""

    name: str
    violated: Column


def not_null(table: str, *columns: str) -> list[RowRule]:
    return [RowRule(f"{table}.{c} not null", F.col(c).isNull()) for c in columns]


def max_length(table: str, lengths: dict[str, int]) -> list[RowRule]:
    return [RowRule(f"{table}.{c} length", F.length(c) > n) for c, n in lengths.items()]


def constraint_report(
    df: DataFrame, constraints: list[Unique | Reference | RowRule]
) -> DataFrame:
    """One row per constraint with its number of violations.

    All row rules share one pass. All keys and references share another: every row gives
    one entry to each of them, the entries are counted before they are shuffled, and one
    shuffle brings equal ones together. A unique constraint counts the values that repeat,
    a reference the rows that point nowhere.
    """
    rules = [c for c in constraints if isinstance(c, RowRule)]
    keyed = [c for c in constraints if not isinstance(c, RowRule)]
    parts = []
    if rules:
        parts.append(_listed(df.agg(*[F.count_if(r.violated).alias(f"c{i}") for i, r in enumerate(rules)]), rules))
    if keyed:
        parts.append(_listed(_keyed_violations(df, keyed), keyed))
    return _union(parts)


def _listed(row: DataFrame, constraints: list) -> DataFrame:
    """One row of counts as one row per constraint."""
    pairs = [
        F.struct(F.lit(c.name).alias("constraint_name"), F.col(f"c{i}").alias("violations"))
        for i, c in enumerate(constraints)
    ]
    return row.select(F.inline(F.array(*pairs)))


def _key(*columns: str) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def _keyed_violations(df: DataFrame, constraints: list[Unique | Reference]) -> DataFrame:
    entries, parents = [], []
    for i, c in enumerate(constraints):
        if isinstance(c, Unique):
            within, key = F.lit(True) if c.where is None else c.where, _key(*c.columns)
        else:
            within, key = F.col(c.column).isNotNull(), _key(c.column)
            parent = c.parent.where(F.col(c.key).isNotNull()).select(_key(c.key).alias("key"))
            parents.append(parent.distinct().select(F.lit(i).alias("number"), "key", F.lit(True).alias("known")))
        entries.append(F.when(within, F.struct(F.lit(i).alias("number"), key.alias("key"))))
    each = df.select(F.inline(F.array_compact(F.array(*entries))))
    counted = each.groupBy("number", "key").agg(F.count(F.lit(1)).alias("n"))
    if parents:
        on = {"number": "number", "key": "key"}
        counted = lookup(counted, _union(parents), on, {"known": "known"}, "left", unique=True)
    violated = [
        F.count_if((F.col("number") == i) & (F.col("n") > 1))
        if isinstance(c, Unique)
        else F.coalesce(F.sum(F.when((F.col("number") == i) & F.col("known").isNull(), F.col("n"))), F.lit(0))
        for i, c in enumerate(constraints)
    ]
    return counted.agg(*[v.alias(f"c{i}") for i, v in enumerate(violated)])
