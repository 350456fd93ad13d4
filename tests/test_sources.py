from datetime import date

import pytest
from pyspark.sql import types as T

from conftest import rows
from starloom import session
from starloom.session import new_path, work_dir
from starloom.sources.readers import read_csv, read_text_columns
from starloom.sources.sinks import append, replace_table, write_version

SCHEMA = T.StructType(
    [
        T.StructField("aircraft_code", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("seat_capacity", T.LongType()),
        T.StructField("since", T.DateType()),
    ]
)


@pytest.fixture
def feed(tmp_path):
    path = tmp_path / "aircraft.csv"
    path.write_text(
        "aircraft_code,model,seat_capacity,since\n"
        "AC01,A320neo,180,2020-01-01\n"
        'AC02,"A321, long",222,2021-02-03\n'
        "AC03,A350,many,2020-01-01\n"
        "AC04,B737\n"
        "AC05,B738,189,2020-13-01\n"
        "AC06,B739,,\n"
    )
    return str(path)


def test_csv_with_declared_types(spark, feed):
    good, bad = read_csv(spark, feed, SCHEMA)
    assert rows(good) == [
        ("AC01", "A320neo", 180, date(2020, 1, 1)),
        ("AC02", "A321, long", 222, date(2021, 2, 3)),
        ("AC06", "B739", None, None),
    ]
    assert good.schema.names == SCHEMA.names
    assert [r[0][:4] for r in rows(bad, "line")] == ["AC03", "AC04", "AC05"]


def test_csv_rows_are_the_same_whichever_columns_are_read(spark, feed):
    good, _ = read_csv(spark, feed, SCHEMA)
    assert good.count() == 3
    assert rows(good, "aircraft_code") == [("AC01",), ("AC02",), ("AC06",)]


def test_a_header_of_other_columns_fails(spark, tmp_path):
    path = tmp_path / "renamed.csv"
    path.write_text("code,model,seat_capacity,since\nAC01,A320neo,180,2020-01-01\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), SCHEMA).rows.collect()


def test_text_columns(spark, feed):
    raw = read_text_columns(spark, feed)
    assert raw.columns == SCHEMA.names
    assert {t for _, t in raw.dtypes} == {"string"}


def test_a_table_is_replaced_from_itself(spark):
    first = replace_table(spark.range(10), "refreshed")
    again = replace_table(spark.table("refreshed").where("id < 4"), "refreshed")
    assert first.columns == again.columns
    assert spark.table("refreshed").count() == 4


def test_a_failed_check_keeps_the_old_version(spark):
    replace_table(spark.range(10), "guarded")

    def check(df):
        if df.count() < 5:
            raise ValueError("too few rows")

    with pytest.raises(ValueError):
        replace_table(spark.range(2), "guarded", check=check)
    assert spark.table("guarded").count() == 10


def test_layers_are_made_as_needed(spark):
    replace_table(spark.range(3), "silver.things")
    assert spark.table("silver.things").count() == 3


def test_partitioned_version_prunes_through_the_view(spark):
    df = spark.range(100).selectExpr("id", "id % 5 as part")
    shown = replace_table(df, "split_table", partition_by=["part"])
    june = shown.where("part = 3")
    assert june.count() == 20
    assert "PartitionFilters: [isnotnull(part" in june._jdf.queryExecution().executedPlan().toString()


def test_partition_columns_keep_their_types(spark):
    df = spark.createDataFrame(
        [(1, "007", 7, True, date(2025, 6, 1)), (2, "010", 10, False, date(2025, 6, 2))],
        "id long, code string, month int, flag boolean, day date",
    )
    shown = replace_table(df, "typed_table", partition_by=["month", "flag", "day"])
    assert shown.schema == df.schema
    assert rows(shown) == rows(df)
    with pytest.raises(ValueError, match="code"):
        replace_table(df, "typed_table", partition_by=["code"])


def test_append_takes_columns_by_name(spark):
    path = new_path(spark, "appended")
    spark.createDataFrame([(1, "a")], "id long, name string").write.parquet(path)
    append(spark.createDataFrame([("b", 9, 2)], "name string, extra long, id long"), path, ["id", "name"])
    assert rows(spark.read.schema("id long, name string").parquet(path)) == [(1, "a"), (2, "b")]


def test_a_version_is_never_overwritten(spark):
    path = new_path(spark, "version")
    write_version(spark.range(3), path)
    with pytest.raises(Exception):
        write_version(spark.range(4), path)
    assert spark.read.parquet(path).count() == 3


class FakeSession:
    """What ``work_dir`` asks of a session."""

    def __init__(self, master, named):
        self.named = named
        self.sparkContext = self
        self.conf = self
        self.master = master
        self.applicationId = "app-1"

    def get(self, name, default=None):
        return self.named if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_work_folder_is_the_one_the_session_names(monkeypatch):
    monkeypatch.setattr(session, "_WORK_DIRS", {})
    assert work_dir(FakeSession("yarn", "hdfs://shared/tmp/")) == "hdfs://shared/tmp/app-1"


def test_a_cluster_without_a_named_folder_is_refused(monkeypatch):
    monkeypatch.setattr(session, "_WORK_DIRS", {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(FakeSession("yarn", None))
