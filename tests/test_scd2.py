from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starloom.functions.dates import OPEN_END
from starloom.model import History
from starloom.operators.scd2 import (
    DuplicateKeyError,
    prepare_feed,
    scd2_apply,
    scd2_broken_chains,
    scd2_change_profile,
    scd2_check,
    scd2_history,
    scd2_init,
    scd2_not_one_current,
    scd2_version_counts,
)
from starloom.plans.warehouse import PASSENGER

SPEC = History()
AS_OF = date(2026, 3, 17)
SIGNUP = date(2020, 5, 1)
OPEN = date.fromisoformat(OPEN_END)
DIM = (
    "passenger_key long, passenger_id long, passenger_name string, home_airport_key long, "
    "frequent_flyer_tier string, signup_date date"
)
FEED = "passenger_id long, passenger_name string, frequent_flyer_tier string, home_airport_key long"


def dim(spark, *given):
    """(key, id, name, home, tier) rows as a first load."""
    return scd2_init(spark.createDataFrame([(*g, SIGNUP) for g in given], DIM), SPEC)


def feed(spark, *given):
    """(id, name, tier, home) rows."""
    return spark.createDataFrame(list(given), FEED)


@pytest.fixture
def two(spark):
    return dim(spark, (1, 70, "Ada", 5, "Blue"), (2, 71, "Bo", 6, "Gold"))


def shown(df):
    return rows(
        df, "passenger_key", "passenger_id", "passenger_name", "frequent_flyer_tier", "home_airport_key",
        "signup_date", "is_current", "effective_from", "effective_to",
    )


def test_change_closes_the_old_version_and_opens_a_new_one(spark, two):
    got = scd2_apply(two, feed(spark, (70, "Ada", "Silver", 5)), SPEC, AS_OF).dimension
    assert shown(got) == [
        (1, 70, "Ada", "Blue", 5, SIGNUP, False, SIGNUP, AS_OF),
        (2, 71, "Bo", "Gold", 6, SIGNUP, True, SIGNUP, OPEN),
        (3, 70, "Ada", "Silver", 5, SIGNUP, True, AS_OF, OPEN),
    ]


def test_new_passenger_signed_up_on_the_day(spark, two):
    got = scd2_apply(two, feed(spark, (900, "New", "Blue", 5)), SPEC, AS_OF).dimension
    assert shown(got.where("passenger_id = 900")) == [
        (3, 900, "New", "Blue", 5, AS_OF, True, AS_OF, OPEN)
    ]


def test_new_versions_are_numbered_by_passenger(spark, two):
    given = [(900, "N", "Blue", 5), (71, "S", "Silver", 6), (70, "K", "Silver", 5)]
    opened = scd2_apply(two, feed(spark, *given), SPEC, AS_OF).opened
    assert rows(opened, "passenger_id", "passenger_key") == [(70, 3), (71, 4), (900, 5)]


def test_a_new_name_alone_opens_no_version_but_travels_with_one(spark, two):
    same = scd2_apply(two, feed(spark, (70, "Ada S", "Blue", 5)), SPEC, AS_OF).dimension
    assert shown(same) == shown(two)
    moved = scd2_apply(two, feed(spark, (70, "Ada S", "Blue", 8)), SPEC, AS_OF).dimension
    assert rows(moved.where("passenger_id = 70"), "passenger_name", "home_airport_key", "is_current") == [
        ("Ada S", 8, True),
        ("Ada", 5, False),
    ]


def test_running_the_same_feed_again_changes_nothing(spark, two):
    given = feed(spark, (70, "Ada", "Silver", 5), (900, "New", "Blue", 5))
    once = scd2_apply(two, given, SPEC, AS_OF).dimension
    twice = scd2_apply(once, given, SPEC, AS_OF).dimension
    assert shown(twice) == shown(once)


def test_a_second_change_on_one_day_corrects_the_version(spark, two):
    once = scd2_apply(two, feed(spark, (70, "Ada", "Silver", 5)), SPEC, AS_OF).dimension
    twice = scd2_apply(once, feed(spark, (70, "Ada", "Gold", 9)), SPEC, AS_OF).dimension
    assert shown(twice.where("passenger_id = 70")) == [
        (1, 70, "Ada", "Blue", 5, SIGNUP, False, SIGNUP, AS_OF),
        (3, 70, "Ada", "Gold", 9, SIGNUP, True, AS_OF, OPEN),
    ]


def test_a_change_the_day_after_makes_a_third_version(spark, two):
    once = scd2_apply(two, feed(spark, (70, "Ada", "Silver", 5)), SPEC, AS_OF).dimension
    day = AS_OF + timedelta(1)
    got = scd2_apply(once, feed(spark, (70, "Ada", "Gold", 5)), SPEC, day).dimension
    assert rows(got.where("passenger_id = 70"), "effective_from", "effective_to") == [
        (SIGNUP, AS_OF), (AS_OF, day), (day, OPEN),
    ]
    assert [r.passenger_id for r in scd2_history(got, SPEC, F.col("passenger_id") == 70).collect()] == [70] * 3


def test_an_id_twice_in_the_feed_fails(spark, two):
    twice = feed(spark, (70, "Ada", "Silver", 5), (70, "Ada", "Gold", 5))
    with pytest.raises(DuplicateKeyError, match="70"):
        scd2_apply(two, twice, SPEC, AS_OF)


def test_a_feed_older_than_the_version_fails(spark, two):
    with pytest.raises(Exception, match="older than the version"):
        scd2_apply(two, feed(spark, (70, "Ada", "Silver", 5)), SPEC, SIGNUP - timedelta(1))


def test_feed_rows_that_cannot_be_applied_are_kept_as_rejects(spark):
    airports = spark.createDataFrame([("DEL", 5)], "airport_code string, airport_key long")
    updates = spark.createDataFrame(
        [(70, "K", "DEL", "Gold"), (71, "S", "XXX", "Gold"), (72, "T", "DEL", None), (None, "U", None, "Blue")],
        "passenger_id long, passenger_name string, home_airport_code string, frequent_flyer_tier string",
    )
    accepted, rejects = prepare_feed(updates, SPEC, PASSENGER.parents, {"airport": airports})
    assert rows(accepted) == [(70, "K", "Gold", 5)]
    assert rows(rejects, "passenger_name", "reasons") == [
        ("S", ["no home airport"]),
        ("T", ["frequent_flyer_tier is null"]),
        ("U", ["passenger_id is null", "no home airport"]),
    ]


def test_null_in_the_dimension_counts_as_a_value(spark):
    unknown = dim(spark, (1, 70, "K", 5, None))
    changes = scd2_apply(unknown, feed(spark, (70, "K", "Gold", 5)), SPEC, AS_OF).changes
    assert rows(changes, "action", "frequent_flyer_tier_changed") == [("changed", True)]


@pytest.fixture
def published(spark):
    """1,500 passengers; 200 change (191 the tier, 91 the home airport), 50 are new."""
    ids = spark.range(1500)
    base = scd2_init(
        ids.select(
            (F.col("id") + 1).alias("passenger_key"),
            (F.col("id") + 700000).alias("passenger_id"),
            F.concat(F.lit("P"), "id").alias("passenger_name"),
            (F.col("id") % 24 + 1).alias("home_airport_key"),
            F.lit("Blue").alias("frequent_flyer_tier"),
            F.lit(SIGNUP).alias("signup_date"),
        ),
        SPEC,
    )
    changed = ids.where("id < 200").select(
        (F.col("id") + 700000).alias("passenger_id"),
        F.concat(F.lit("P"), "id").alias("passenger_name"),
        F.when(F.col("id") < 191, "Silver").otherwise("Blue").alias("frequent_flyer_tier"),
        (F.col("id") % 24 + 1 + F.when(F.col("id") >= 109, 1).otherwise(0)).alias("home_airport_key"),
    )
    new = spark.range(50).select(
        (F.col("id") + 900000).alias("passenger_id"),
        F.lit("New").alias("passenger_name"),
        F.lit("Blue").alias("frequent_flyer_tier"),
        F.lit(1).cast("long").alias("home_airport_key"),
    )
    return base, changed.unionByName(new)


@pytest.mark.parametrize("broadcast", [True, False])
def test_published_totals(spark, published, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    applied = scd2_apply(*published, SPEC, AS_OF)
    got = applied.dimension
    assert rows(scd2_version_counts(got, SPEC)) == [(1750, 1550)]
    assert rows(scd2_change_profile(applied.changes, SPEC)) == [(200, 191, 91, 82, 0, 50)]
    assert scd2_not_one_current(got, SPEC).count() == 0
    assert scd2_broken_chains(got, SPEC).count() == 0
    assert sorted(r.passenger_key for r in got.collect()) == list(range(1, 1751))
    assert rows(got.where("passenger_id = 700000"), "frequent_flyer_tier", "is_current") == [
        ("Blue", False), ("Silver", True),
    ]
    assert got.where("passenger_id = 900000").count() == 1


def test_dimension_is_not_shuffled_for_a_small_feed(spark, published):
    base, changes = published
    kept = scd2_apply(base, changes, SPEC, AS_OF).kept
    plan = plan_of(kept)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_invariants(spark, two):
    got = scd2_apply(two, feed(spark, (70, "Ada", "Silver", 5)), SPEC, AS_OF).dimension
    fact = spark.createDataFrame([(1,), (3,), (9,), (9,)], "passenger_key long")
    assert dict(rows(scd2_check(got, SPEC, fact))) == {
        "key is unique": 0,
        "at most one current version": 0,
        "current means open": 0,
        "validity is not empty": 0,
        "exactly one current version": 0,
        "unbroken validity": 0,
        "fact finds its version": 2,
    }
    wrong = got.withColumn("is_current", F.lit(True)).withColumn("passenger_key", F.lit(1))
    assert {n: v for n, v in rows(scd2_check(wrong, SPEC)) if v} == {
        "key is unique": 1,
        "at most one current version": 1,
        "current means open": 1,
        "exactly one current version": 1,
    }


def chain(spark, *spans):
    return spark.createDataFrame(
        [(p, a, b) for p, a, b in spans], "passenger_id long, effective_from date, effective_to date"
    )


@pytest.mark.parametrize(
    "name, spans, fault",
    [
        ("unbroken", [(0, 5), (5, 9), (9, 20)], None),
        ("gap", [(0, 5), (6, 9)], "gap"),
        ("overlap", [(0, 5), (4, 9)], "overlap"),
        ("inside", [(0, 9), (3, 5)], "overlap"),
        ("both", [(0, 5), (4, 8), (9, 12)], "overlap and gap"),
        ("twice", [(0, 5), (0, 5)], "overlap"),
        ("empty", [(0, 5), (5, 5), (5, 9)], "empty version"),
        ("one", [(0, 5)], None),
    ],
)
def test_broken_chains(spark, name, spans, fault):
    d = date(2025, 1, 1)
    df = chain(spark, *[(1, d + timedelta(a), d + timedelta(b)) for a, b in spans])
    got = [r.fault for r in scd2_broken_chains(df, SPEC).collect()]
    assert got == ([] if fault is None else [fault])


@hypothesis_settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.dictionaries(
        st.integers(1, 20),
        st.lists(st.tuples(st.integers(0, 12), st.integers(1, 6)), min_size=1, max_size=4),
        min_size=1,
    )
)
def test_chains_against_sorting_each_entity(spark, given_spans):
    d = date(2025, 1, 1)
    spans = {p: [(a, a + n) for a, n in s] for p, s in given_spans.items()}
    df = chain(spark, *[(p, d + timedelta(a), d + timedelta(b)) for p, s in spans.items() for a, b in s])
    wrong = {
        p for p, s in spans.items() if any(x[1] != y[0] for x, y in zip(sorted(s), sorted(s)[1:]))
    }
    assert {r.passenger_id for r in scd2_broken_chains(df, SPEC).collect()} == wrong


@hypothesis_settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 2),
            st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from("BSG"), st.integers(1, 2)), min_size=1),
        ),
        min_size=1,
        max_size=3,
    )
)
def test_feeds_against_a_ledger(spark, feeds):
    """Any run of feeds gives what a passenger-by-passenger ledger gives."""
    state = dim(spark, (1, 1, "A", 1, "B"), (2, 2, "B", 1, "B"))
    ledger = {1: [("B", 1, SIGNUP, OPEN)], 2: [("B", 1, SIGNUP, OPEN)]}
    day = AS_OF
    for wait, values in feeds:
        day += timedelta(wait)
        given = feed(spark, *[(p, "N", tier, home) for p, (tier, home) in values.items()])
        state = scd2_apply(state, given, SPEC, day).dimension
        for p, (tier, home) in values.items():
            versions = ledger.setdefault(p, [])
            if not versions:
                versions.append((tier, home, day, OPEN))
            elif versions[-1][:2] != (tier, home):
                _, _, begin, _ = versions[-1]
                if begin == day:
                    versions[-1] = (tier, home, day, OPEN)
                else:
                    versions[-1] = (*versions[-1][:3], day)
                    versions.append((tier, home, day, OPEN))
    got = rows(
        state, "passenger_id", "frequent_flyer_tier", "home_airport_key", "effective_from", "effective_to"
    )
    assert got == sorted(((p, *v) for p, vs in ledger.items() for v in vs), key=repr)
    keys = [r.passenger_key for r in state.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_one_passenger_with_very_many_versions_is_spread(spark, many_partitions):
    d = date(1900, 1, 1)
    df = spark.range(20_000).select(
        F.lit(1).cast("long").alias("passenger_id"),
        F.date_add(F.lit(d), F.col("id").cast("int")).alias("effective_from"),
        F.date_add(F.lit(d), F.col("id").cast("int") + 1).alias("effective_to"),
    )
    got = scd2_broken_chains(df, SPEC)
    assert got.count() == 0
    assert "Window" not in plan_of(got)
