"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from __spark_entry__ import SMALL, entry, oracle_sql, queries  # noqa: E402
from starloom.plans.oracle import ORACLE  # noqa: E402
from starloom.plans.queries import QUERIES  # noqa: E402
from compare import canonical  # noqa: E402
from conftest import plan_of  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in sorted(Path(SMALL).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


# no cross joins, no rows through Python
NOT_WANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    df = QUERIES[name](spark, SMALL)
    plan = plan_of(df)
    assert [operator for operator in NOT_WANTED if operator in plan] == []
    expected = sql.sql(ORACLE[name]).to_arrow_table()
    assert canonical(df.toArrow()) == canonical(expected)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    assert entry(spark).columns == ["tier", "bookings", "total_fare"]
