"""Stored layout of a type-2 dimension.

Versions lie in folders by the day they ended, current ones under the open end, and a
manifest lists the folders that are shown (see ``manifest``). The accepted rows of
every feed are kept as well. A load writes the current slice and the versions it
closes; older history stays as it is. A feed of a day before days already applied is
spliced in: its entities' versions from that day on are made again from the kept rows,
and only the days on which such versions end are written anew. So the days may come
in any order. A load that dies at any step shows nothing and can run again.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.dates import OPEN_END
from starloom.model import History
from starloom.operators.checks import grain_check
from starloom.operators.joins import lookup
from starloom.operators.scd2 import (
    FEED_DAY,
    FEED_NUMBER,
    OLDER,
    UNCHANGED,
    Applied,
    Spliced,
    scd2_apply,
    scd2_splice,
)
from starloom.sources.manifest import ROWS, Entry, ManifestTable
from starloom.sources.sinks import write_version

FEED = "feed"
DAY, LAST_KEY = "starloom.day", "starloom.last_key"


class TooOldError(ValueError):
    """A feed's day lies before the first day on which one of its entities is known."""


class HistoryStore:
    """The dimension ``table`` and the feeds that made it."""

    def __init__(self, spark: SparkSession, table: str, spec: History):
        self.spark, self.table, self.spec = spark, table, spec
        self.stored = ManifestTable(spark, table, spec.validity[1])

    def create(self, dim: DataFrame) -> None:
        """Store a first load, all of it current."""
        last = dim.agg(F.max(self.spec.key)).first()[0] or 0
        self.stored.create(dim.select(*self.spec.columns), {LAST_KEY: str(last), DAY: ""})

    def exists(self) -> bool:
        return self.stored.exists()

    def last_day(self) -> date | None:
        """The latest day whose feed was applied."""
        day = self.stored.properties()[DAY]
        return date.fromisoformat(day) if day else None

    def read(self) -> DataFrame:
        return self.stored.read()

    def current(self) -> DataFrame:
        return self.read().where(F.col(self.spec.validity[1]) == F.lit(OPEN_END).cast("date"))

    def feeds(self, since: date | None = None) -> DataFrame:
        """Accepted rows of all feeds of that day and later, with their day and number."""
        parts = [e.part for e in self.stored.entries() if e.kind == FEED and (since is None or e.value >= since.isoformat())]
        columns = {f.name: f.dataType.simpleString() for f in self.read().schema.fields}
        kinds = {FEED_DAY: "date", FEED_NUMBER: "int"} | {c: columns[c] for c in self.spec.feed_columns}
        schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.stored.folder(FEED, p) for p in parts])

    def apply(self, feed: DataFrame, as_of: date, batch: str | None = None) -> Applied | Spliced | None:
        """Apply one day's feed, late or not; None if this ``batch`` has applied the day."""
        try:
            return self._apply(feed, as_of, batch)
        except PySparkException as error:
            if OLDER not in str(error):
                raise
            raise TooOldError(f"{self.table}: a feed of {as_of} changes versions of the first load") from error

    def _apply(self, feed: DataFrame, as_of: date, batch: str | None) -> Applied | Spliced | None:
        entries, day = self.stored.entries(), as_of.isoformat()
        fed = [e for e in entries if e.kind == FEED]
        if batch is not None and any(e.batch == batch and e.value == day for e in fed):
            return None
        known = self.stored.properties()
        last_day, last_key = known[DAY], int(known[LAST_KEY])
        number = 1 + max((e.number for e in fed), default=0)
        if last_day and day < last_day:
            done: Applied | Spliced = scd2_splice(self.read(), feed, self.feeds(as_of), self.spec, as_of, last_key)
            changed, listed = self._spliced(done, entries)
        else:
            done = scd2_apply(self.current(), feed, self.spec, as_of, last_key)
            changed = not done.changes.where(F.col("action") != UNCHANGED).isEmpty()
            listed = [e for e in entries if e.kind != ROWS or e.value != OPEN_END] if changed else entries
            if changed:
                listed = listed + self.stored.write(done.dimension.select(*self.spec.columns))
        if changed:
            last_key = self._check(set(listed) - set(entries), last_key)
        noted = self._keep(feed, as_of, number, batch)
        self.stored.publish([*listed, noted], {DAY: max(day, last_day), LAST_KEY: str(last_key)})
        return done

    def _spliced(self, done: Spliced, entries: list[Entry]) -> tuple[bool, list[Entry]]:
        """Write the days on which replaced or new versions end."""
        gone, made = done.replaced.select(*self.spec.columns), done.versions
        # counted first, in the footers: comparing all rows of unequal sets would tell no more
        if made.count() == gone.count() and made.exceptAll(gone).isEmpty():
            return False, entries
        end, key = self.spec.validity[1], self.spec.key
        # one row per day
        days = [r[0] for r in gone.select(end).union(made.select(end)).distinct().collect()]
        same_days = self.read().where(F.col(end).isin(days))
        others = lookup(same_days, gone, {key: key}, how="left_anti", unique=True)
        written = self.stored.write(others.select(*self.spec.columns).unionByName(made))
        texts = {d.isoformat() for d in days}
        return True, [e for e in entries if e.kind != ROWS or e.value not in texts] + written

    def _check(self, written: set[Entry], last_key: int) -> int:
        """A version is shown only if it has one current row per entity; the last key it gave."""
        parts = {e.part for e in written}
        rows = self.spark.read.schema(self.read().schema).parquet(
            *[self.stored.folder("rows", f"starloom_part={p}") for p in parts]
        )
        twice = grain_check(rows.where(F.col(self.spec.current)), [self.spec.business_key]).limit(20).collect()
        if twice:
            ids = ", ".join(str(r[0]) for r in twice)
            raise ValueError(f"{self.table} has several current versions of {ids}")
        return max(last_key, rows.agg(F.max(self.spec.key)).first()[0] or 0)

    def _keep(self, feed: DataFrame, as_of: date, number: int, batch: str | None) -> Entry:
        part = uuid.uuid4().int >> 66
        rows = feed.select(F.lit(as_of).alias(FEED_DAY), F.lit(number).alias(FEED_NUMBER), *self.spec.feed_columns)
        write_version(rows, self.stored.folder(FEED, part))
        return Entry(FEED, part, as_of.isoformat(), number=number, batch=batch)
