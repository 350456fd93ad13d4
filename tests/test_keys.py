import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starloom.operators.keys import assign_keys, number_rows


def test_numbers_follow_the_order_over_many_partitions(spark, many_partitions):
    ids = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("code"))
    keyed = number_rows(ids, ["code"], "sk")
    assert keyed.select("__part") if "__part" in keyed.columns else True
    got = [tuple(r) for r in keyed.orderBy("code").select("sk").collect()]
    assert got == [(i + 1,) for i in range(20_000)]


def test_several_partitions_take_part(spark, many_partitions):
    ids = spark.range(20_000).withColumnRenamed("id", "code")
    staged = number_rows(ids, ["code"], "sk")
    assert staged.rdd.getNumPartitions() > 1


def test_composite_text_keys(spark, many_partitions):
    rows_in = [("Paris", "US"), ("Paris", "FR"), ("Abu Dhabi", "AE"), ("Delhi", "IN")]
    keyed = number_rows(spark.createDataFrame(rows_in, "city string, country string"), ["city", "country"], "sk")
    assert [(r.city, r.country, r.sk) for r in keyed.orderBy("sk").collect()] == [
        ("Abu Dhabi", "AE", 1),
        ("Delhi", "IN", 2),
        ("Paris", "FR", 3),
        ("Paris", "US", 4),
    ]


def test_known_keys_stay_and_new_ones_continue(spark):
    old = assign_keys(spark.createDataFrame([(c,) for c in "bdf"], "code string"), ["code"], "sk")
    new = spark.createDataFrame([(c,) for c in "abcdef"], "code string")
    got = assign_keys(new, ["code"], "sk", existing=old)
    assert rows(got, "code", "sk") == [("a", 4), ("b", 1), ("c", 5), ("d", 2), ("e", 6), ("f", 3)]


def test_loading_the_same_again_changes_nothing(spark):
    src = spark.range(50).withColumnRenamed("id", "code")
    first = assign_keys(src, ["code"], "sk")
    assert rows(assign_keys(src, ["code"], "sk", existing=first)) == rows(first)


def test_empty_input(spark):
    assert number_rows(spark.range(0), ["id"], "sk").count() == 0


def test_no_window_and_no_single_partition(spark, many_partitions):
    plan = plan_of(number_rows(spark.range(1000), ["id"], "sk"))
    assert "Window" not in plan and "SinglePartition" not in plan


@hypothesis_settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    old=st.sets(st.integers(-1000, 1000), max_size=40), new=st.sets(st.integers(-1000, 1000), max_size=40)
)
def test_dense_and_stable(spark, old, new):
    def frame(codes):
        return spark.createDataFrame([(c,) for c in codes], "code long")

    first = assign_keys(frame(old), ["code"], "sk")
    second = assign_keys(frame(new | old), ["code"], "sk", existing=first)
    before, after = dict(rows(first, "code", "sk")), dict(rows(second, "code", "sk"))
    assert sorted(after.values()) == list(range(1, len(old | new) + 1))
    assert all(after[c] == sk for c, sk in before.items())


@pytest.mark.parametrize("start", [0, 1750])
def test_numbering_continues_after_start(spark, start):
    keyed = number_rows(spark.range(5), ["id"], "sk", start)
    assert [r.sk for r in keyed.orderBy("sk").collect()] == [start + i for i in range(1, 6)]
