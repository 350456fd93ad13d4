"""Month partitions of a fact: boundaries, numbering, report, pruned reads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.columns import all_of
from starloom.functions.dates import date_key

MONTH = "travel_month"


def month_boundaries(df: DataFrame, day: str) -> DataFrame:
    """Numbered date keys that open a partition each.

    They run from the month of the earliest ``day`` to one past the latest.
    """
    bounds = df.agg(
        F.trunc(F.min(day), "month").alias("first"),
        F.add_months(F.trunc(F.max(day), "month"), 1).alias("last"),
    )
    step = F.expr("interval 1 month")
    starts = bounds.select(F.posexplode(F.sequence("first", "last", step)).alias("at", "start"))
    return starts.select(
        (F.col("at") + 1).alias("boundary_id"), date_key(F.col("start")).alias("boundary_key")
    )


def boundary_keys(df: DataFrame, day: str) -> list[int]:
    """The boundaries as a list, one entry per month of the data's date range."""
    return sorted(r["boundary_key"] for r in month_boundaries(df, day).collect())


def boundaries_between(first: date, last: date) -> list[int]:
    """The same for a range of days that is known."""
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month + 1)
    return [m // 12 * 10_000 + (m % 12 + 1) * 100 + 1 for m in months]


def range_partition(key: Column, boundaries: list[int]) -> Column:
    """Partition number where a boundary value belongs to the partition it opens.

    ``n`` boundaries make ``n + 1`` partitions, open at both ends; NULL goes to
    the first. The comparisons form a balanced tree.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low + 1)
        middle = (low + high) // 2
        return F.when(key < boundaries[middle], search(low, middle)).otherwise(
            search(middle + 1, high)
        )

    return F.when(key.isNull(), F.lit(1)).otherwise(search(0, len(boundaries)))


def partition_report(fact: DataFrame, key: str, boundaries: list[int]) -> DataFrame:
    """Rows per partition, empty ones included.

    The upper boundary is exclusive and NULL for the last partition.
    """
    counts = fact.groupBy(range_partition(F.col(key), boundaries).alias("partition_number")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return _every_partition(counts, boundaries)


def partition_report_by_month(
    months: DataFrame, boundaries: list[int], month: str = MONTH
) -> DataFrame:
    """The same report from the rows per month, for boundaries that open months each."""
    off = [b for b in boundaries if b % 100 != 1]
    if off:
        raise ValueError(f"boundaries within a month: {off[:5]}")
    number = range_partition(F.col(month) * 100 + 1, boundaries).alias("partition_number")
    return _every_partition(months.groupBy(number).agg(F.sum("rows").alias("rows")), boundaries)


def _every_partition(counts: DataFrame, boundaries: list[int]) -> DataFrame:
    every = [(n + 1, b) for n, b in enumerate([*boundaries, None])]
    partitions = counts.sparkSession.createDataFrame(
        every, "partition_number int, upper_boundary_key int"
    )
    return (
        partitions.join(counts, "partition_number", "left")
        .select(
            "partition_number",
            "upper_boundary_key",
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
        .orderBy("partition_number")
    )


def month_range(low: int, high: int, month: str = MONTH) -> Column:
    """Months that can hold keys in ``[low, high)``.

    An exclusive end on the first of a month leaves that month out.
    """
    last = F.col(month) < high // 100 if high % 100 <= 1 else F.col(month) <= high // 100
    return (F.col(month) >= low // 100) & last


def pruned_range(
    fact: DataFrame, low: int, high: int, key: str = "travel_date_key", month: str = MONTH
) -> DataFrame:
    """Rows with ``low <= key < high``, reading only the months concerned."""
    return fact.where(month_range(low, high, month) & (F.col(key) >= low) & (F.col(key) < high))


def range_total(rows: DataFrame, amount: str) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("bookings"), F.sum(amount).cast("decimal(38,2)").alias("total_fare")
    )


def partitions_scanned(df: DataFrame) -> int:
    """Partitions that the scan of ``df`` read, by the scan's own metric. Runs ``df``."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    scan = plan.collectLeaves().apply(0)
    while not scan.metrics().contains("numFiles"):
        scan = scan.plan().collectLeaves().apply(0)
    return int(scan.metrics().apply("numPartitions").value())


def partitions_read(
    fact: DataFrame, name: str, *predicates: Column, month: str = MONTH
) -> DataFrame:
    """How many month partitions a query with these month predicates reads.

    Only partition values are looked at; Spark answers that from the directory
    listing with the files' footers.
    """
    read = all_of(predicates)
    months = fact.groupBy(month).agg(F.lit(1).alias("one"))
    return months.agg(
        F.lit(name).alias("query"),
        F.count_if(read).alias("partitions_read"),
        F.count(F.lit(1)).alias("partitions_total"),
    )
