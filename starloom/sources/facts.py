"""Stored layout of a fact: folders by month, listed by a manifest.

A day's rows are added in folders of their own. When a type-2 dimension changes at a
day that facts have passed, those facts are pointed at the version that is valid now,
and only the months that hold such rows are written again. A rebuild compares every
month with a digest kept next to its folders and writes the months that differ.
"""

from __future__ import annotations

from collections import defaultdict
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.columns import differs
from starloom.functions.dates import day_of, month_of
from starloom.model import Fact, History, Parent
from starloom.operators.facts import asof_lookup
from starloom.operators.joins import lookup
from starloom.session import stage
from starloom.sources.manifest import ROWS, Entry, ManifestTable, digest_of
from starloom.sources.sinks import by_month

DAY = "day"


class LostVersionError(RuntimeError):
    """A fact row's day has no version any more."""


class FactStore:
    """The fact ``table`` in month folders of ``key``."""

    def __init__(self, spark: SparkSession, table: str, spec: Fact, key: str, month: str = "travel_month"):
        self.spark, self.table, self.spec, self.key, self.month = spark, table, spec, key, month
        self.stored = ManifestTable(spark, table, month, digests=True)

    def exists(self) -> bool:
        return self.stored.exists()

    def read(self) -> DataFrame:
        return self.stored.read()

    def days(self) -> set[str]:
        """Days whose rows were added."""
        return {e.value for e in self.stored.entries() if e.kind == DAY}

    def months(self) -> DataFrame:
        """Rows per month, from the manifest alone."""
        rows = [(int(e.value), e.rows) for e in self.stored.entries() if e.kind == ROWS]
        counts = self.spark.createDataFrame(rows, f"{self.month} int, rows long")
        return counts.groupBy(self.month).agg(F.sum("rows").alias("rows"))

    def add(self, fact: DataFrame, day: date) -> bool:
        """Add a day's rows, once; whether they were added now."""
        if not self.exists():
            self.stored.create(self._monthly(fact).where(F.lit(False)))
        entries, text = self.stored.entries(), day.isoformat()
        if any(e.kind == DAY and e.value == text for e in entries):
            return False
        written = self.stored.write(self._monthly(fact), place=self._placed)
        self.stored.publish([*entries, *written, Entry(DAY, 0, text)], {})
        return True

    def repoint(
        self,
        replaced: DataFrame,
        dim: DataFrame,
        history: History,
        parent: Parent,
        day_key: str,
        since: date | None = None,
    ) -> list[int]:
        """Point rows at the versions valid on their day; the months written again.

        ``replaced`` holds the versions that a change ended or removed, ``dim`` the
        dimension now. ``since`` is the change's day if no row's month lies before the
        month of its ``day_key``: earlier months are then not read.
        """
        fact, entity = self.read(), history.business_key
        rows = fact if since is None else fact.where(F.col(self.month) >= since.year * 100 + since.month)
        old = stage(replaced.select(history.key, entity), "replaced")
        hit = lookup(rows, old, {parent.result: history.key}, {entity: "__entity"})
        hit = hit.select(*self.spec.grain, self.month, parent.result, "__entity", day_of(F.col(day_key)).alias("__day"))
        versions = stage(lookup(dim, old.select(entity).distinct(), {entity: entity}, how="left_semi"), "versions")
        now = asof_lookup(hit, versions, history, {"__entity": entity}, "__day", {history.key: "__now"})
        moved = stage(now.where(differs(F.col("__now"), F.col(parent.result))), "moved")
        if not moved.where("__now IS NULL").isEmpty():
            raise LostVersionError(f"{self.table}: rows of {parent.role} without a version")
        # one row per month
        months = sorted(r[0] for r in moved.select(self.month).distinct().collect())
        if not months:
            return []
        whole = fact.where(F.col(self.month).isin(months))
        on = {c: c for c in self.spec.grain}
        pointed = lookup(whole, moved, on, {"__now": "__now"}, "left", unique=True)
        pointed = pointed.withColumn(parent.result, F.coalesce("__now", parent.result)).select(*fact.columns)
        self._exchange({str(m) for m in months}, pointed)
        return months

    def rebuild(self, fact: DataFrame) -> list[int]:
        """Make the table hold these rows; the months written, those that differ.

        ``fact`` is read twice, for the digests and for the months to write.
        """
        if not self.exists():
            self.stored.create(self._monthly(fact).where(F.lit(False)))
        made = self._monthly(fact).select(*self.read().columns)
        digest = digest_of(made.columns).cast("string").alias("digest")
        given = {
            str(r[self.month]): (r["rows"], Decimal(r["digest"]))
            for r in made.groupBy(self.month).agg(F.count(F.lit(1)).alias("rows"), digest).collect()
        }
        kept: dict[str, tuple[int, Decimal]] = defaultdict(lambda: (0, Decimal(0)))
        for e in self.stored.entries():
            if e.kind == ROWS:
                rows, summed = kept[e.value]
                kept[e.value] = rows + e.rows, summed + Decimal(e.digest)
        changed = {m for m in given.keys() | kept.keys() if given.get(m) != kept.get(m)}
        if changed:
            self._exchange(changed, made.where(F.col(self.month).isin([int(m) for m in changed])))
        return sorted(int(m) for m in changed)

    def _monthly(self, fact: DataFrame) -> DataFrame:
        return fact.drop(self.month).withColumn(self.month, month_of(F.col(self.key)))

    def _placed(self, rows: DataFrame) -> DataFrame:
        return by_month(rows, self.key, self.spec.grain, self.month)

    def _exchange(self, months: set[str], rows: DataFrame) -> None:
        written = self.stored.write(rows, place=self._placed)
        others = [e for e in self.stored.entries() if e.kind != ROWS or e.value not in months]
        self.stored.publish(others + written, {})
