from datetime import date, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.functions.dates import day_of
from starloom.model import Fact, Parent
from starloom.sources.facts import FactStore
from starloom.sources.history import HistoryStore
from starloom.sources.manifest import ManifestTable
from test_scd2 import AS_OF, SPEC, dim, feed

PASSENGER = Parent("passenger", "passenger", {"passenger_id": "passenger_id"}, "passenger_key", "passenger_key")
SALES = Fact("sales", ["booking_id"], (PASSENGER,), ["fare"])
COLUMNS = "booking_id long, travel_date_key int, booking_date_key int, passenger_key long, fare int"


@pytest.fixture
def facts(spark):
    return FactStore(spark, f"sales_{uuid4().hex[:8]}", SALES, "travel_date_key")


def sales(spark, *given):
    return spark.createDataFrame(list(given), COLUMNS)


def folders(store):
    return {(e.part, e.value) for e in store.stored.entries() if e.kind == "rows"}


FIRST = [(1, 20260320, 20260310, 1, 5), (2, 20260401, 20260318, 1, 6), (3, 20260401, 20260320, 2, 7), (4, 20260501, 20260312, 1, 8)]


def test_a_days_rows_are_added_once_beside_the_others(spark, facts):
    assert facts.add(sales(spark, *FIRST), date(2026, 3, 20))
    before = folders(facts)
    assert facts.add(sales(spark, (5, 20260402, 20260321, 2, 9)), date(2026, 3, 21))
    assert not facts.add(sales(spark, (5, 20260402, 20260321, 2, 9)), date(2026, 3, 21))
    assert before < folders(facts) and len(folders(facts)) == len(before) + 1
    assert rows(facts.read(), "booking_id") == [(i,) for i in range(1, 6)]
    assert rows(facts.months()) == [(202603, 1), (202604, 3), (202605, 1)]
    assert facts.days() == {"2026-03-20", "2026-03-21"}


def test_rows_are_pointed_at_the_version_of_their_day(spark, facts):
    history = HistoryStore(spark, f"passenger_{uuid4().hex[:8]}", SPEC)
    history.create(dim(spark, (1, 70, "K", 5, "Blue"), (2, 71, "S", 6, "Gold")))
    facts.add(sales(spark, *FIRST), date(2026, 3, 20))
    before = folders(facts)
    done = history.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF)  # 17 March
    written = facts.repoint(done.replaced, history.read(), SPEC, PASSENGER, "booking_date_key", since=AS_OF)
    assert written == [202604]
    assert {v for _, v in before & folders(facts)} == {"202603", "202605"}
    assert rows(facts.read(), "booking_id", "passenger_key") == [(1, 1), (2, 3), (3, 2), (4, 1)]
    # a late day ends the first version earlier, and says what the later day said
    done = history.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF - timedelta(6))
    written = facts.repoint(done.replaced, history.read(), SPEC, PASSENGER, "booking_date_key")
    assert written == [202604, 202605]
    found = facts.read().join(history.read(), "passenger_key").where(
        (day_of(F.col("booking_date_key")) >= F.col("effective_from")) & (day_of(F.col("booking_date_key")) < F.col("effective_to"))
    )
    assert found.count() == 4
    assert facts.repoint(done.replaced, history.read(), SPEC, PASSENGER, "booking_date_key") == []


def test_only_months_that_differ_are_written(spark, facts):
    assert facts.rebuild(sales(spark, *FIRST)) == [202603, 202604, 202605]
    before = folders(facts)
    assert facts.rebuild(sales(spark, *reversed(FIRST)).repartition(3)) == [] and folders(facts) == before
    changed = [*FIRST[:3], (4, 20260501, 20260312, 1, 9), (6, 20260601, 20260312, 1, 9)]
    assert facts.rebuild(sales(spark, *changed)) == [202605, 202606]
    assert {v for _, v in before & folders(facts)} == {"202603", "202604"}
    assert facts.rebuild(sales(spark, *changed[1:])) == [202603]
    assert rows(facts.read(), "booking_id", "fare") == [(2, 6), (3, 7), (4, 9), (6, 9)]
    assert facts.rebuild(sales(spark)) == [202604, 202605, 202606] and facts.read().count() == 0


def test_a_rebuild_that_dies_shows_nothing(spark, facts, monkeypatch):
    facts.rebuild(sales(spark, *FIRST))
    with monkeypatch.context() as m:
        m.setattr(ManifestTable, "publish", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            facts.rebuild(sales(spark, *FIRST[1:]))
    assert facts.read().count() == 4
    assert facts.rebuild(sales(spark, *FIRST[1:])) == [202603] and facts.read().count() == 3


def test_rows_without_month_are_refused(spark, facts):
    with pytest.raises(ValueError, match="travel_month"):
        facts.add(sales(spark, (1, None, 20260310, 1, 5)), date(2026, 3, 20))


def test_month_conditions_prune_folders(spark, facts):
    facts.rebuild(sales(spark, *FIRST))
    months = {f.split("travel_month=")[1][:6] for (f,) in facts.read().where("travel_month = 202604").select(F.input_file_name()).distinct().collect()}
    assert months == {"202604"}


def test_superseded_folders_go_after_their_grace(spark, facts):
    facts.rebuild(sales(spark, *FIRST))
    facts.rebuild(sales(spark, *FIRST[1:]))
    reader = facts.read()
    for day in range(8):
        facts.rebuild(sales(spark, *FIRST[1:3], (4, 20260501, 20260312, 1, 100 + day)))
    facts.stored.write(facts.read())  # a writer that died
    held = facts.stored.vacuum()
    assert held == [] and reader.count() == 3
    listed = folders(facts)
    removed = facts.stored.vacuum(grace=timedelta(0))
    assert {r.split("/")[0] for r in removed} == {"rows", "manifests"}
    kept = {name for name, _ in facts.stored._folders(f"{facts.stored.properties()['starloom.root']}/rows")}
    assert kept == {f"starloom_part={part}" for part, _ in listed}
    assert len(facts.stored.versions()) == 1
    assert rows(facts.read(), "booking_id", "fare") == [(2, 6), (3, 7), (4, 107)]
    assert facts.rebuild(sales(spark, *FIRST)) == [202603, 202605] and facts.stored.vacuum(grace=timedelta(0)) != []


def test_kept_versions_keep_their_folders(spark, facts):
    facts.rebuild(sales(spark, *FIRST))
    reader = facts.read()
    facts.rebuild(sales(spark, *FIRST[1:]))
    facts.stored.vacuum(keep=3, grace=timedelta(0))
    assert reader.count() == 4
