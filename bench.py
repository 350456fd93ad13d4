"""Headline timings: prints one JSON line.

First the whole warehouse is built from the given tables. Then each operator runs
again on the stored tables it needs, its own stored result dropped before. The
range queries also report how many month partitions their scans read, by the scans'
own metrics.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.partitions import partitions_scanned
from starloom.plans import queries as q
from starloom.plans.warehouse import Warehouse


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starloom")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def build(w: Warehouse) -> None:
    """Everything the warehouse stores, down to the partitioned line fact."""
    for df in (w.load.fact, w.dim_history, w.geography_levels["airport"], w.booking_fact, w.line_fact):
        run(df)


# query -> the warehouse's own stored results it has to make again
TIMED: dict[Callable[[Warehouse], DataFrame], tuple[str, ...]] = {
    q.calendar_dim: (),
    q.surrogate_keys: (),
    q.surrogate_keys_incremental: (),
    q.dim_passenger: ("dim_passenger",),
    q.dim_flight: ("dim_flight",),
    q.key_lookup: (),
    q.role_playing_join: (),
    q.snowflake_resolve: ("geography_levels",),
    q.fact_load: ("load",),
    q.fact_reconciliation: (),
    q.orphan_check: (),
    q.scd2_apply: ("applied", "dim_history"),
    q.scd2_no_overlap: (),
    q.scd2_version_counts: (),
    q.asof_fact_load: (),
    q.asof_vs_current: (),
    q.fact_partitioned_write: ("line_fact_path",),
    q.partition_report: (),
    q.range_partition_number: (),
    q.sales_by_travel_range: (),
    q.sales_by_status_class: (),
    q.additive_rollup_month: (),
    q.additive_rollup_route: (),
    q.ratio_rollup: (),
    q.grain_check: (),
    q.functional_dependency: (),
    q.constraint_report: (),
    q.contract_types: (),
    q.contract_notnull: (),
    q.contract_quarantine: (),
    q.contract_date_order: (),
    q.contract_freshness: (),
    q.contract_volume_by_day: (),
    q.csv_bronze_roundtrip: (),
    q.full_refresh_idempotent: (),
    q.month_sales_through_dims: (),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    warehouse = Warehouse(spark, folder)
    seconds: dict[str, float] = {}
    start = time.perf_counter()
    build(warehouse)
    seconds["warehouse_build_cold"] = round(time.perf_counter() - start, 3)
    for query, made in TIMED.items():
        for name in made:
            vars(warehouse).pop(name, None)
        start = time.perf_counter()
        run(query(warehouse))
        seconds[query.__name__] = round(time.perf_counter() - start, 3)
    touched = {
        "travel range": partitions_scanned(q.sales_by_travel_range(warehouse)),
        "status and class": partitions_scanned(q.sales_by_status_class(warehouse)),
    }
    report = {
        "metric": "warehouse_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "partitions_read": touched,
        "sf": folder.rsplit("sf", 1)[-1].strip("/"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
