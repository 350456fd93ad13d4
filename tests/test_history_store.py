import random
from datetime import date, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import types as T

from conftest import plan_of, rows
from starloom.functions.dates import OPEN_END
from starloom.operators.scd2 import DuplicateKeyError, scd2_apply, scd2_broken_chains, scd2_not_one_current
from starloom.plans.warehouse import PASSENGER
from starloom.session import new_path
from starloom.sources.history import HistoryStore, TooOldError
from starloom.sources.manifest import ManifestTable
from starloom.streaming import feeds
from test_scd2 import AS_OF, SPEC, dim, feed, shown


@pytest.fixture
def store(spark):
    made = HistoryStore(spark, f"passenger_{uuid4().hex[:8]}", SPEC)
    made.create(dim(spark, (1, 70, "K", 5, "Blue"), (2, 71, "S", 6, "Gold"), (3, 72, "T", 6, "Gold")))
    return made


FEEDS = [
    (0, (70, "K", "Silver", 5), (900, "N", "Blue", 5)),
    (0, (71, "S", "Silver", 6), (70, "K", "Gold", 5)),
    (1, (70, "K", "Gold", 6), (72, "T", "Blue", 6)),
]


def test_stored_dimension_equals_the_one_in_memory(spark, store):
    plain = store.read()
    for days, *given in FEEDS:
        day = AS_OF + timedelta(days)
        plain = scd2_apply(plain, feed(spark, *given), SPEC, day).dimension
        store.apply(feed(spark, *given), day)
        assert shown(store.read()) == shown(plain)
    assert store.read().schema.simpleString() == plain.schema.simpleString()
    assert scd2_not_one_current(store.read(), SPEC).count() == 0
    assert scd2_broken_chains(store.read(), SPEC).count() == 0


def test_running_a_day_again_changes_nothing(spark, store):
    for _ in range(2):
        store.apply(feed(spark, *FEEDS[0][1:]), AS_OF)
    once = shown(store.read())
    store.apply(feed(spark, *FEEDS[0][1:]), AS_OF)
    assert shown(store.read()) == once and len(once) == 5


STEPS = [
    (ManifestTable, "write"),
    (HistoryStore, "_check"),
    (HistoryStore, "_keep"),
    (ManifestTable, "_select"),
    (ManifestTable, "publish"),
]


@pytest.mark.parametrize("days", [-1, 0, 1], ids=["late", "same day", "next day"])
def test_a_load_that_dies_at_any_step_shows_nothing_and_runs_again(spark, store, monkeypatch, days):
    """Also on the second feed of a day, and on a late day."""
    first, given, day = FEEDS[0][1:], FEEDS[1][1:], AS_OF + timedelta(days)
    plain = dim(spark, (1, 70, "K", 5, "Blue"), (2, 71, "S", 6, "Gold"), (3, 72, "T", 6, "Gold"))
    for of_day, row in sorted([(AS_OF, first), (day, given)], key=lambda x: x[0]):
        plain = scd2_apply(plain, feed(spark, *row), SPEC, of_day).dimension
    wanted = keyless(plain)
    store.apply(feed(spark, *first), AS_OF)
    before, reader = shown(store.read()), store.read()
    for owner, name in STEPS:
        work = getattr(owner, name)

        def dies(*args, **kind):
            if name != "publish":  # publishing is one replacement of the view
                work(*args, **kind)
            raise RuntimeError("executor lost")

        with monkeypatch.context() as m:
            m.setattr(owner, name, dies)
            with pytest.raises(RuntimeError, match="executor lost"):
                store.apply(feed(spark, *given), day)
        assert shown(store.read()) == before
    store.apply(feed(spark, *given), day)
    assert keyless(store.read()) == wanted
    assert shown(reader) == before


def test_a_version_with_two_current_rows_of_one_id_is_not_shown(spark):
    store = HistoryStore(spark, f"passenger_{uuid4().hex[:8]}", SPEC)
    store.create(dim(spark, (1, 70, "K", 5, "Blue"), (2, 70, "K", 5, "Blue"), (3, 71, "S", 6, "Gold")))
    before = shown(store.read())
    with pytest.raises(ValueError, match="70"):
        store.apply(feed(spark, (71, "S", "Silver", 6)), AS_OF)
    assert shown(store.read()) == before


def test_current_versions_are_read_without_the_history(spark, store):
    store.apply(feed(spark, *FEEDS[0][1:]), AS_OF)
    store.apply(feed(spark, *FEEDS[2][1:]), AS_OF + timedelta(1))
    scan = store.current()
    assert plan_of(scan).count("FileScan") == 1
    assert {r[0] for r in scan.select("effective_to").distinct().collect()} == {date.fromisoformat(OPEN_END)}
    # folders are chosen while files are listed: no condition is left for the rows
    assert "Filter" not in plan_of(scan).replace("PartitionFilters", "").replace("PushedFilters", "").replace("DataFilters", "")


AIRPORTS = [("DEL", 5), ("BOM", 6)]
UPDATES = T.StructType(
    [
        T.StructField("passenger_id", T.LongType()),
        T.StructField("passenger_name", T.StringType()),
        T.StructField("home_airport_code", T.StringType()),
        T.StructField("frequent_flyer_tier", T.StringType()),
    ]
)
HEADER = "passenger_id,passenger_name,home_airport_code,frequent_flyer_tier,feed_date\n"


def test_streamed_feeds(spark, store, tmp_path):
    source = tmp_path / "feeds"
    source.mkdir()
    airports = spark.createDataFrame(AIRPORTS, "airport_code string, airport_key long")
    log, rejects = new_path(spark, "log"), new_path(spark, "rejects")

    def run():
        dims = {"airport": airports}
        feeds.apply_feed(spark, str(source), UPDATES, store, PASSENGER.parents, dims, log, rejects)

    (source / "day1.csv").write_text(
        HEADER + "70,K,DEL,Silver,2026-03-17\n71,S,XXX,Silver,2026-03-17\nno number,S,DEL,Silver,2026-03-17\n"
    )
    run()
    assert rows(store.read().where("passenger_id = 70"), "effective_from", "frequent_flyer_tier") == [
        (date(2020, 5, 1), "Blue"), (date(2026, 3, 17), "Silver"),
    ]
    after_one = shown(store.read())
    run()
    assert shown(store.read()) == after_one
    (source / "day2.csv").write_text(
        HEADER + "70,K,BOM,Silver,2026-03-19\n70,K,BOM,Gold,2026-03-18\n"
    )
    run()
    assert rows(store.read().where("passenger_id = 70"), "effective_from", "home_airport_key") == [
        (date(2020, 5, 1), 5), (date(2026, 3, 17), 5), (date(2026, 3, 18), 6), (date(2026, 3, 19), 6),
    ]
    lost = spark.read.parquet(f"{rejects}/batch=0/day=2026-03-17")
    assert rows(lost, "passenger_id", "reasons") == [(71, ["no home airport"])]
    unreadable = spark.read.parquet(f"{rejects}/batch=0/unreadable")
    assert unreadable.count() == 1


def test_refused_days_become_dead_letters_and_can_be_replayed(spark, store, tmp_path):
    source = tmp_path / "feeds"
    source.mkdir()
    dims = {"airport": spark.createDataFrame(AIRPORTS, "airport_code string, airport_key long")}
    log, rejects = new_path(spark, "log"), new_path(spark, "rejects")

    def run():
        return feeds.apply_feed(spark, str(source), UPDATES, store, PASSENGER.parents, dims, log, rejects)

    (source / "twice.csv").write_text(HEADER + "70,K,DEL,Silver,2026-03-17\n70,K,DEL,Gold,2026-03-17\n")
    (source / "old.csv").write_text(HEADER + "71,S,BOM,Silver,1999-01-01\n")
    (source / "good.csv").write_text(HEADER + "72,T,BOM,Silver,2026-03-18\n")
    dead = run()
    report = {r["feed_date"]: r for r in dead.report().collect()}
    assert {d: (r["reason"], r["rows"]) for d, r in report.items()} == {
        date(2026, 3, 17): ("a key twice", 2), date(1999, 1, 1): ("older than the first load", 1),
    }
    assert report[date(1999, 1, 1)]["files"][0].endswith("old.csv")
    assert store.read().where("passenger_id = 72").count() == 2 and store.read().count() == 4
    # the stream goes on, and the day that was refused comes late once it is mended
    (source / "next.csv").write_text(HEADER + "70,K,DEL,Gold,2026-03-19\n")
    dead = run()
    assert dead.replay(lambda rows: rows.where("frequent_flyer_tier <> 'Gold'")) == [date(2026, 3, 17)]
    assert rows(store.read().where("passenger_id = 70"), "effective_from", "frequent_flyer_tier") == [
        (date(2020, 5, 1), "Blue"), (date(2026, 3, 17), "Silver"), (date(2026, 3, 19), "Gold"),
    ]
    assert [r["feed_date"] for r in dead.report().collect()] == [date(1999, 1, 1)]


def test_ingest_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, log = new_path(spark, "landed"), new_path(spark, "log")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    (source / "a.csv").write_text("id,name\n1,a\nx,b\n")
    first = feeds.ingest(spark, str(source), schema, target, log)
    assert rows(first.rows) == [(1, "a")] and first.quarantined.count() == 1
    (source / "b.csv").write_text("id,name\n2,b\n")
    again = feeds.ingest(spark, str(source), schema, target, log)
    assert rows(again.rows) == [(1, "a"), (2, "b")]


def test_first_load_is_all_current(spark, store):
    assert rows(store.read(), "is_current") == [(True,)] * 3



def keyless(df):
    return rows(
        df, "passenger_id", "passenger_name", "frequent_flyer_tier", "home_airport_key", "signup_date",
        "is_current", "effective_from", "effective_to",
    )


LATE = [
    # 70 changes and changes back, 71 says the same twice, 901 is new on every day
    (1, (70, "K1", "Silver", 5), (71, "S1", "Gold", 6), (901, "N1", "Blue", 5)),
    (4, (70, "K2", "Blue", 5), (71, "S2", "Blue", 6), (901, "N2", "Gold", 5)),
    (9, (70, "K3", "Blue", 6), (71, "S3", "Blue", 6), (901, "N3", "Gold", 5), (902, "M", "Blue", 5)),
]


@pytest.mark.parametrize("order", [(2, 1, 0), (1, 2, 0)])
def test_days_in_any_order_give_the_same_dimension(spark, store, order):
    plain = store.read()
    for days, *given in LATE:
        plain = scd2_apply(plain, feed(spark, *given), SPEC, AS_OF + timedelta(days)).dimension
    wanted = keyless(plain)
    for i in order:
        days, *given = LATE[i]
        store.apply(feed(spark, *given), AS_OF + timedelta(days))
    assert keyless(store.read()) == wanted
    assert store.read().select("passenger_key").distinct().count() == len(wanted)
    assert scd2_broken_chains(store.read(), SPEC).count() == 0


def test_random_feeds_in_random_order(spark, store):
    """Also several feeds of one day, whose own order counts."""
    r = random.Random(8)
    feeds_of = [
        (day, [(i, f"n{day}{k}", r.choice(["Blue", "Gold"]), r.choice([5, 6])) for i in (70, 71, 72, 900, 901) if r.random() < 0.7])
        for k, day in enumerate([1, 2, 2, 4])
    ]
    plain = store.read()
    for day, given in feeds_of:
        plain = scd2_apply(plain, feed(spark, *given), SPEC, AS_OF + timedelta(day)).dimension
    wanted = keyless(plain)
    for i in (3, 1, 0, 2):
        day, given = feeds_of[i]
        store.apply(feed(spark, *given), AS_OF + timedelta(day))
    assert keyless(store.read()) == wanted


def test_a_late_day_leaves_other_days_and_keys_alone(spark, store):
    store.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF)
    store.apply(feed(spark, (71, "S", "Silver", 6)), AS_OF + timedelta(5))
    before = {e for e in store.stored.entries() if e.kind == "rows"}
    keys = rows(store.read().where("passenger_id <> 71"), "passenger_key", "passenger_id", "effective_from")
    done = store.apply(feed(spark, (71, "S", "Blue", 6)), AS_OF + timedelta(2))
    kept = {e for e in store.stored.entries() if e.kind == "rows"} & before
    assert [e.value for e in kept] == [AS_OF.isoformat()]
    assert rows(store.read().where("passenger_id <> 71"), "passenger_key", "passenger_id", "effective_from") == keys
    versions = store.read().where("passenger_id = 71").orderBy("effective_from")
    assert [(v.frequent_flyer_tier, v.passenger_key) for v in versions.collect()] == [("Gold", 2), ("Blue", 6), ("Silver", 5)]
    assert rows(done.replaced, "passenger_key") == [(2,), (5,)]


def test_a_late_day_that_changes_nothing_writes_no_rows(spark, store):
    store.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF + timedelta(5))
    before = {e for e in store.stored.entries() if e.kind == "rows"}
    store.apply(feed(spark, (71, "S", "Gold", 6)), AS_OF)
    assert {e for e in store.stored.entries() if e.kind == "rows"} == before
    assert store.last_day() == AS_OF + timedelta(5)


def test_a_vanished_version_gives_its_key_to_no_other(spark, store):
    store.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF + timedelta(5))
    gone = store.read().agg({"passenger_key": "max"}).first()[0]
    store.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF)
    assert store.read().where("passenger_id = 70").count() == 2
    store.apply(feed(spark, (71, "S", "Blue", 6)), AS_OF + timedelta(6))
    assert gone not in [k for k, in rows(store.read(), "passenger_key")]


def test_days_that_cannot_be_spliced(spark, store):
    store.apply(feed(spark, (70, "K", "Silver", 5)), AS_OF)
    before = shown(store.read())
    with pytest.raises(TooOldError):
        store.apply(feed(spark, (71, "S", "Blue", 6)), date(2019, 1, 1))
    with pytest.raises(DuplicateKeyError):
        store.apply(feed(spark, (71, "S", "Blue", 6), (71, "S", "Gold", 6)), AS_OF - timedelta(9))
    assert shown(store.read()) == before


def test_a_batch_that_runs_again_passes_over_its_days(spark, store):
    days = [(AS_OF, (70, "K", "Silver", 5)), (AS_OF + timedelta(1), (70, "K", "Gold", 5))]
    for _ in range(2):
        for day, row in days:
            store.apply(feed(spark, row), day, "7")
    assert store.read().where("passenger_id = 70").count() == 3
    assert store.last_day() == AS_OF + timedelta(1)
    assert len([e for e in store.stored.entries() if e.kind == "feed"]) == 2


def test_current_versions_have_an_open_end(spark, store):
    store.apply(feed(spark, *FEEDS[0][1:]), AS_OF)
    assert shown(store.current()) == shown(store.read().where("is_current"))
    assert OPEN_END in {e.value for e in store.stored.entries()}


def test_a_first_load_that_died_can_run_again(spark, monkeypatch):
    store = HistoryStore(spark, f"passenger_{uuid4().hex[:8]}", SPEC)
    first = dim(spark, (1, 70, "K", 5, "Blue"))
    with monkeypatch.context() as m:
        m.setattr(ManifestTable, "_select", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.create(first)
    store.create(first)
    assert store.read().count() == 1
    with pytest.raises(ValueError, match="already"):
        store.create(first)
