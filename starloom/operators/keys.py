"""Surrogate keys: dense, unique, in business-key order, stable once given."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from starloom.operators.joins import lookup
from starloom.session import stage


def number_rows(df: DataFrame, order: list[str], key: str, start: int = 0) -> DataFrame:
    """Number rows ``start+1, start+2, …`` in the order of unique columns ``order``.

    Rows are range-partitioned and sorted, written once with their partition and
    position, and shifted by the row counts of the partitions before theirs. Only
    those counts, one per partition, reach the driver.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id())
    )
    pinned = stage(placed, f"numbered-{key}")
    counts = sorted(
        tuple(r) for r in pinned.groupBy("__part").agg(F.count(F.lit(1)), F.min("__at")).collect()
    )
    before = accumulate((n for _, n, _ in counts), initial=start)
    shifts = [(part, offset - first + 1) for (part, _, first), offset in zip(counts, before)]
    offsets = df.sparkSession.createDataFrame(shifts, "__part int, __shift long")
    # one row per partition of the numbering
    return (
        pinned.join(F.broadcast(offsets), "__part")
        .withColumn(key, F.col("__at") + F.col("__shift"))
        .select(key, *df.columns)
    )


def assign_keys(
    df: DataFrame, business_key: list[str], key: str, existing: DataFrame | None = None
) -> DataFrame:
    """Give every row of ``df`` its surrogate key.

    Business keys found in ``existing`` keep the key they have; the others
    continue after the largest. Rows must be unique on ``business_key``.
    """
    if existing is None:
        return number_rows(df, business_key, key)
    on = {c: c for c in business_key}
    matched = lookup(df, existing, on, {key: key}, "left", unique=True)
    known = F.col(key).isNotNull()
    pinned = stage(matched.withColumn("__known", known), f"known-{key}", "__known")
    kept = pinned.where("__known").select(key, *df.columns)
    fresh = pinned.where("not __known").select(*df.columns)
    last = existing.agg(F.max(key)).first()[0] or 0
    return kept.unionByName(number_rows(fresh, business_key, key, start=last))
