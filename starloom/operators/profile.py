"""Batch profiles: what a batch looked like, small enough to keep and compare.

A profile has one row for the batch, one per column (type, values that are not NULL,
smallest and largest) and one per value of a closed list. Profiles of parts merge into
the profile of the whole. Drift and volume compare two profiles, so the earlier batch
is not read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.operators.contract import MAX_DROP, Contract, volume_status

SCHEMA = "kind string, column_name string, detail string, rows long, low string, high string"
_OPTIONAL = " not null"
_NUMBERS = r"^(tinyint|smallint|int|bigint|float|double|decimal).*"


def _kind(field: T.StructField) -> str:
    return field.dataType.simpleString() + ("" if field.nullable else _OPTIONAL)


def batch_profile(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    """One pass over all columns, and one over those with a closed list."""
    fields, nothing = df.schema.fields, F.lit(None).cast("string")
    ordered = [not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in fields]
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, (f, sorts) in enumerate(zip(fields, ordered)):
        name = f"`{f.name}`"
        aggregates.append(F.count(name).alias(f"n{i}"))
        aggregates.append((F.min(name).cast("string") if sorts else nothing).alias(f"low{i}"))
        aggregates.append((F.max(name).cast("string") if sorts else nothing).alias(f"high{i}"))

    def entry(kind: str, name: Column, detail: Column, n: Column, low: Column = nothing, high: Column = nothing) -> Column:
        values = (F.lit(kind), name, detail, n, low, high)
        return F.struct(*[v.alias(c) for v, c in zip(values, ("kind", "column_name", "detail", "rows", "low", "high"))])

    entries = [entry("rows", nothing, nothing, F.col("n"))] + [
        entry("column", F.lit(f.name), F.lit(_kind(f)), F.col(f"n{i}"), F.col(f"low{i}"), F.col(f"high{i}"))
        for i, f in enumerate(fields)
    ]
    columns = df.agg(*aggregates).select(F.inline(F.array(*entries)))
    listed = [c.name for c in contract.columns if c.allowed is not None and c.name in df.columns] if contract else []
    if not listed:
        return columns
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("detail")) for c in listed])
    counts = df.select(F.inline(each)).groupBy("column_name", "detail").agg(F.count(F.lit(1)).alias("rows"))
    values = counts.where("detail IS NOT NULL").select(
        F.lit("value").alias("kind"), "column_name", "detail", "rows", nothing.alias("low"), nothing.alias("high")
    )
    return columns.unionByName(values)


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all batches together."""
    every = reduce(DataFrame.unionByName, profiles)

    def place(value: str) -> Column:
        # numbers compare as numbers, everything else as its text does
        number = F.when(F.col("detail").rlike(_NUMBERS), F.col(value).try_cast("decimal(38,10)"))
        return F.when(F.col(value).isNotNull(), F.struct(number, F.col(value)))

    return every.groupBy("kind", "column_name", "detail").agg(
        F.sum("rows").alias("rows"),
        F.min_by("low", place("low")).alias("low"),
        F.max_by("high", place("high")).alias("high"),
    )


def profile_drift(old: DataFrame, new: DataFrame, contract: Contract | None = None) -> DataFrame:
    """What changed between two batches and whether consumers break, from their profiles."""
    before, after = (
        p.where("kind = 'column'").select("column_name", F.col("detail").alias(name))
        for p, name in ((old, "__old"), (new, "__new"))
    )
    was, now = (F.regexp_replace(c, f"{_OPTIONAL}$", "") for c in ("__old", "__new"))
    change = (
        F.when(F.col("__old").isNull(), "column added")
        .when(F.col("__new").isNull(), "column removed")
        .when(was != now, "column retyped")
    )
    detail = F.when(F.col("__old").isNull(), F.col("__new")).when(F.col("__new").isNull(), was)
    detail = detail.otherwise(F.concat_ws(" to ", was, now))
    optional = F.col("__old").isNull() & ~F.col("__new").endswith(_OPTIONAL)
    columns = (
        before.join(after, "column_name", "full")
        .select(change.alias("change"), "column_name", detail.alias("detail"), (~optional).alias("breaking"))
        .where("change IS NOT NULL")
        .withColumn("rows", F.lit(None).cast("long"))
    )
    if contract is None:
        return columns
    unknown = reduce(
        lambda a, c: a | ((F.col("column_name") == c.name) & ~F.col("detail").isin(*c.allowed)),
        [c for c in contract.columns if c.allowed is not None],
        F.lit(False),
    )
    added = new.where((F.col("kind") == "value") & unknown)
    return columns.unionByName(
        added.select(F.lit("value added").alias("change"), "column_name", "detail", F.lit(True).alias("breaking"), "rows")
    )


def profile_volume(new: DataFrame, old: DataFrame | None = None, max_drop: float = MAX_DROP) -> DataFrame:
    """Row counts of a batch and of the one before it, if there was one."""
    rows = new.where("kind = 'rows'").select("kind", F.col("rows").alias("today_rows"))
    if old is None:
        both = rows.withColumn("prior_rows", F.lit(None).cast("long"))
    else:
        # one row each
        both = rows.join(old.where("kind = 'rows'").select("kind", F.col("rows").alias("prior_rows")), "kind")
    status = volume_status(F.col("today_rows"), F.col("prior_rows"), max_drop)
    return both.select("prior_rows", "today_rows", status.alias("status"))
