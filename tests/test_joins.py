import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starloom.operators.joins import fits_broadcast, lookup, measured_bytes


@pytest.fixture
def fact(spark):
    """A third of all rows has key 7, some have none, some find no parent."""
    key = F.expr("case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 40 end")
    return spark.range(0, 3000, numPartitions=6).select("id", key.alias("fk"))


@pytest.fixture
def dim(spark):
    return spark.range(30).select(F.col("id").alias("code"), (F.col("id") * 10).alias("sk"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, fact, dim, no_broadcast, how):
    take = {"sk": "key"} if how in ("inner", "left") else {}
    got = lookup(fact, dim, {"fk": "code"}, take, how)
    plain = fact.join(dim.select(F.col("code").alias("c"), *[F.col(c).alias(n) for c, n in take.items()]),
                      F.col("fk") == F.col("c"), how)
    if "c" in plain.columns:
        plain = plain.drop("c")
    assert rows(got) == rows(plain)


def test_heavy_key_is_spread_over_tasks(spark, fact, dim, no_broadcast, many_partitions, settings):
    settings(spark__starloom__rowsPerTask=100)
    joined = lookup(fact, dim, {"fk": "code"}, {"sk": "key"})
    held = joined.where("fk = 7").groupBy(F.spark_partition_id().alias("p")).count()
    counts = [r["count"] for r in held.collect()]
    assert sum(counts) == fact.where("fk = 7").count()
    assert len(counts) > 3
    assert max(counts) < sum(counts) / 2


def test_exact_copies_are_spread_too(spark, dim, no_broadcast, many_partitions, settings):
    settings(spark__starloom__rowsPerTask=100)
    same = spark.range(0, 4000, numPartitions=16).select(F.lit(7).cast("long").alias("fk"))
    joined = lookup(same, dim, {"fk": "code"}, {"sk": "key"})
    counts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 4000 and len(counts) > 2


def test_small_side_is_broadcast_and_large_one_is_not(spark, fact, dim, settings):
    assert "BroadcastHashJoin" in plan_of(lookup(fact, dim, {"fk": "code"}, {"sk": "key"}))
    settings(spark__starloom__broadcastBytes=100, spark__sql__autoBroadcastJoinThreshold=-1)
    assert "BroadcastHashJoin" not in plan_of(lookup(fact, dim, {"fk": "code"}, {"sk": "key"}))


def test_a_side_over_the_budget_is_not_broadcast_by_spark_either(spark, dim, fact, settings):
    settings(spark__starloom__broadcastBytes=100)  # far under Spark's own threshold
    plan = plan_of(lookup(fact, dim, {"fk": "code"}, {"sk": "key"}, unique=True))
    assert "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan


def test_measured_size_bounds_the_data(spark):
    text = spark.range(100).select(F.repeat(F.lit("x"), 50).alias("t"))
    assert measured_bytes(text) >= 100 * 50
    assert measured_bytes(text.limit(0)) == 0
    lists = spark.range(10).select(F.sequence(F.lit(1), F.lit(100)).alias("numbers"))
    assert measured_bytes(lists) >= 10 * 100 * 2
    assert fits_broadcast(text)


def test_no_cartesian_product(spark, fact, dim, no_broadcast):
    plan = plan_of(lookup(fact, dim, {"fk": "code"}, {"sk": "key"}))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_condition_besides_the_key(spark, fact, dim, no_broadcast):
    got = lookup(fact, dim, {"fk": "code"}, {"sk": "key"}, "left", F.col("id") > F.col("key"))
    expected = fact.where("fk < 30 and id > fk * 10").count()
    assert got.where("key is not null").count() == expected
    assert got.count() == fact.count()


def test_a_name_the_source_has_cannot_be_taken(spark, fact, dim):
    with pytest.raises(ValueError, match="id"):
        lookup(fact, dim, {"fk": "code"}, {"sk": "id"})


def test_outer_joins_of_the_side_are_refused(spark, fact, dim):
    with pytest.raises(ValueError):
        lookup(fact, dim, {"fk": "code"}, {}, "full")


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_a_side_that_repeats_a_key_is_reduced_first(spark, no_broadcast, settings, many_partitions, how):
    ids = spark.range(100)
    side = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 50).cast("long").alias("code")
    )
    got = lookup(ids, side, {"id": "code"}, how=how, unique=True)
    expected = ids.join(side, F.col("id") == F.col("code"), how)
    plan = plan_of(got)
    assert rows(got) == rows(expected)
    assert plan.count("HashAggregate") >= 2
    assert plan.count("Exchange hashpartitioning") == 2
