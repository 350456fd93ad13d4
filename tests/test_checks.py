from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starloom.model import Fact, Measure, Ratio
from starloom.operators.checks import (
    Reference,
    RowRule,
    Unique,
    constraint_report,
    date_range_profile,
    functional_dependency,
    grain_check,
    max_length,
    not_null,
    orphan_check,
    orphans,
    reconcile,
    row_count_report,
)
from starloom.operators.rollup import NonAdditiveError, rollup


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([(1,), (2,)], "id long")


@pytest.fixture
def child(spark):
    return spark.createDataFrame([(10, 1), (11, 1), (12, 3), (13, 3), (14, None), (14, 2)], "k long, fk long")


def test_row_counts(spark, parent, child):
    empty = parent.limit(0)
    got = row_count_report({"parent": parent, "child": child, "empty": empty})
    assert rows(got) == [("child", 6), ("empty", 0), ("parent", 2)]


def test_reconciliation(spark, parent, child):
    assert rows(reconcile(child, parent)) == [(6, 2, 4)]


def test_orphans(spark, parent, child, no_broadcast):
    assert rows(orphans(child, "fk", parent, "id")) == [(3, 2)]
    assert rows(orphan_check(child, {"p": ("fk", parent, "id"), "q": ("k", child, "k")})) == [(2, 0)]


def test_verification_needs_no_cross_join(spark, parent, child):
    for df in (reconcile(child, parent), orphan_check(child, {"p": ("fk", parent, "id")})):
        assert "Cartesian" not in plan_of(df) and "NestedLoop" not in plan_of(df)


def test_grain_and_dependency(spark, child):
    assert rows(grain_check(child, ["k"])) == [(14, 2)]
    assert rows(grain_check(child, ["k", "fk"])) == []
    assert rows(functional_dependency(child, ["fk"], "k")) == [(1, 2), (3, 2)]


def test_date_ranges(spark):
    df = spark.createDataFrame([(date(2024, 11, 2), date(2025, 1, 1)), (date(2025, 2, 1), None)], "a date, b date")
    assert rows(date_range_profile(df, "a", "b")) == [
        ("a", date(2024, 11, 2), date(2025, 2, 1)),
        ("b", date(2025, 1, 1), date(2025, 1, 1)),
    ]


def test_constraints(spark, parent, child):
    got = constraint_report(
        child.withColumn("name", F.lit("abcd")),
        [
            Unique("pk", ("k",)),
            Unique("pk of parents", ("k",), F.col("fk") < 3),
            Reference("fk", "fk", parent, "id"),
            *not_null("child", "k", "fk"),
            *max_length("child", {"name": 3}),
            RowRule("small", F.col("k") > 12),
        ],
    )
    assert dict(rows(got)) == {
        "pk": 1,
        "pk of parents": 0,
        "fk": 2,
        "child.k not null": 0,
        "child.fk not null": 1,
        "child.name length": 6,
        "small": 3,
    }


SALES = Fact(
    "sales",
    ["id"],
    (),
    [],
    measures=(Measure("fare", "fare"), Measure("miles", "miles"), Measure("rate", "rate", additive=False)),
    ratios=(
        Ratio("average_fare", "fare"),
        Ratio("fare_by_mile", "fare", "miles"),
        Ratio("bad", "rate"),
    ),
)


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("a", 100, 10, 1.0), ("a", 200, 30, 2.0), ("b", 50, 0, 3.0)],
        "route string, fare long, miles long, rate double",
    )


def test_sums_and_ratios_at_report_grain(sales):
    got = rollup(sales, SALES, ["route"], ["fare", "average_fare", "fare_by_mile"])
    assert rows(got, "route", "bookings", "fare", "average_fare", "fare_by_mile") == [
        ("a", 2, 300, 150.0, 7.5),
        ("b", 1, 50, 50.0, None),
    ]
    whole = rollup(sales, SALES, [], ["average_fare"]).collect()
    assert whole[0].average_fare == pytest.approx(350 / 3)


@pytest.mark.parametrize("measure", ["rate", "bad", "unheard_of"])
def test_what_does_not_add_up_is_refused(sales, measure):
    with pytest.raises(NonAdditiveError):
        rollup(sales, SALES, ["route"], [measure])
