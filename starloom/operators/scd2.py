"""Type-2 history: versions with half-open validity ``[from, to)``.

The daily feed is small next to the dimension. It is compared with the current
versions once, the outcome is written (at most one row per feed row), and the
dimension is then passed over once more to close the versions that changed.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.columns import any_of, differs, failed_names
from starloom.functions.dates import open_end
from starloom.model import History, Parent
from starloom.operators.checks import RowRule, Unique, constraint_report, orphan_rows
from starloom.operators.dims import resolve_parents
from starloom.operators.joins import lookup
from starloom.operators.keys import number_rows
from starloom.session import stage

NEW, CHANGED, CORRECTED, UNCHANGED = "new", "changed", "corrected", "unchanged"
OLDER = "feed is older than the version it changes"


class DuplicateKeyError(ValueError):
    """A feed names one business key more than once."""


class Feed(NamedTuple):
    accepted: DataFrame
    rejects: DataFrame


class Applied(NamedTuple):
    """``replaced`` holds the versions that ended, as facts of later days refer to them."""

    changes: DataFrame
    kept: DataFrame
    opened: DataFrame
    replaced: DataFrame

    @property
    def dimension(self) -> DataFrame:
        return self.kept.unionByName(self.opened)


class Spliced(NamedTuple):
    """Versions that reach up to a late day or beyond it, and those that take their place."""

    replaced: DataFrame
    versions: DataFrame


def scd2_init(dim: DataFrame, spec: History) -> DataFrame:
    """Version 1 of every row: current, valid since it was first seen."""
    begin, end = spec.validity
    return dim.withColumns(
        {spec.current: F.lit(True), begin: F.col(spec.first_seen), end: open_end()}
    ).select(*spec.columns)


def prepare_feed(
    updates: DataFrame, spec: History, parents: tuple[Parent, ...], dims: dict[str, DataFrame]
) -> Feed:
    """Resolve the feed's parents; rows that cannot be applied become rejects."""
    resolved = resolve_parents(updates, parents, dims, "left")
    keys = {p.result for p in parents}
    wrong = {
        f"{c} is null": F.col(c).isNull()
        for c in (spec.business_key, *spec.copied, *spec.tracked)
        if c not in keys
    }
    wrong |= {f"no {p.role}": F.col(p.result).isNull() for p in parents}
    marked = resolved.withColumn("reasons", failed_names(wrong))
    # written once: the feed is looked at several times before it is applied
    judged = stage(marked.withColumn("rejected", F.size("reasons") > 0), "feed", "rejected")
    accepted = judged.where("not rejected").select(*spec.feed_columns)
    rejects = judged.where("rejected").select(*updates.columns, "reasons")
    return Feed(accepted, rejects)


def _check_unique(feed: DataFrame, spec: History) -> None:
    twice = feed.groupBy(spec.business_key).count().where("count > 1").limit(20).collect()
    if twice:
        ids = ", ".join(str(r[0]) for r in twice)
        raise DuplicateKeyError(f"feed repeats {spec.business_key}: {ids}")


def scd2_change_set(dim: DataFrame, feed: DataFrame, spec: History, as_of: date) -> DataFrame:
    """What the feed does to the current versions: one row per feed row.

    A change on the day its version began corrects that version in place, as an
    empty interval could never be found again.
    """
    begin, _ = spec.validity
    touched = lookup(
        dim.where(F.col(spec.current)),
        feed,
        {spec.business_key: spec.business_key},
        how="left_semi",
        unique=True,
    )
    old = {c: f"old_{c}" for c in [*spec.tracked, spec.first_seen, begin]}
    before = touched.select(
        F.col(spec.business_key).alias("__id"), *[F.col(c).alias(n) for c, n in old.items()]
    )
    flags = {f"{c}_changed": differs(F.col(f"old_{c}"), F.col(c)) for c in spec.tracked}
    known = F.col("__id").isNotNull()
    changed = any_of(F.col(f) for f in flags)
    started = F.col(f"old_{begin}")
    late = F.raise_error(F.concat(F.lit(f"{OLDER}: "), "__id"))
    action = (
        F.when(~known, NEW)
        .when(~changed, UNCHANGED)
        .when(started == F.lit(as_of), CORRECTED)
        .when(started > F.lit(as_of), late.cast("string"))
        .otherwise(CHANGED)
    )
    joined = feed.join(before, F.col(spec.business_key) == F.col("__id"), "left")
    seen = F.coalesce(F.col(f"old_{spec.first_seen}"), F.lit(as_of)).alias(spec.first_seen)
    marked = joined.withColumns({f: known & c for f, c in flags.items()})
    return marked.withColumn("action", action).select(*spec.feed_columns, seen, "action", *flags)


def scd2_apply(
    dim: DataFrame, feed: DataFrame, spec: History, as_of: date, last_key: int | None = None
) -> Applied:
    """Close changed versions, open their successors, add new entities.

    Applying the same feed again changes nothing. New versions are numbered after
    ``last_key``, or after the largest key in ``dim``.
    """
    _check_unique(feed, spec)
    changes = stage(scd2_change_set(dim, feed, spec, as_of), "changes")
    kept = _kept(dim, changes, spec, as_of)
    ended = lookup(
        kept.where(~F.col(spec.current) & (F.col(spec.validity[1]) == F.lit(as_of))),
        changes.where(F.col("action") == CHANGED),
        {spec.business_key: spec.business_key},
        how="left_semi",
    )
    return Applied(changes, kept, _opened(dim, changes, spec, as_of, last_key), ended)


FEED_DAY, FEED_NUMBER = "feed_day", "feed_number"


def scd2_splice(
    dim: DataFrame, feed: DataFrame, later: DataFrame, spec: History, as_of: date, last_key: int
) -> Spliced:
    """Apply the feed of a day that lies before days already applied.

    ``later`` holds the accepted rows of all feeds of that day and of later ones, with
    the day and the number of their feed. The versions of the feed's entities that reach
    up to the day are made again from these rows and from the version that was valid
    the day before, as if all feeds had come in the order of their days. A version that still
    begins on its day keeps its key; new ones are numbered after ``last_key``.
    """
    _check_unique(feed, spec)
    (begin, end), entity = spec.validity, spec.business_key
    on, values = {entity: entity}, [*spec.copied, *spec.tracked]
    # with the version that ended on the day: what it held tells what the day changes
    reach = dim.where(F.col(end) >= F.lit(as_of))
    replaced = stage(lookup(reach, feed, on, how="left_semi"), "replaced")
    said = lookup(later.where(F.col(FEED_DAY) >= F.lit(as_of)), feed, on, how="left_semi")
    day, number = F.lit(as_of).alias(FEED_DAY), F.lit(2**31 - 1).alias(FEED_NUMBER)
    named = [FEED_DAY, FEED_NUMBER, *spec.feed_columns]
    seen = stage(said.select(*named).unionByName(feed.select(day, number, *spec.feed_columns)), "seen")
    # a version that no feed began comes from the first load, or from before the day
    given = lookup(
        replaced, seen, {entity: entity, begin: FEED_DAY}, how="left_anti"
    )
    older = F.raise_error(F.concat(F.lit(f"{OLDER}: "), entity))
    first = F.when(F.col(begin) <= F.lit(as_of), F.col(spec.first_seen)).otherwise(older.cast("date"))
    held = given.select(
        F.col(begin).alias(FEED_DAY), F.lit(-1).alias(FEED_NUMBER), *spec.feed_columns, first.alias("__first")
    )
    rows = seen.withColumn("__first", F.lit(None).cast("date")).unionByName(held)
    order = Window.partitionBy(entity).orderBy(FEED_DAY, FEED_NUMBER)
    moved = F.lag(FEED_DAY).over(order).isNull() | any_of(
        differs(F.lag(c).over(order), F.col(c)) for c in spec.tracked
    )
    whole = Window.partitionBy(entity)
    marked = rows.withColumn("__moved", moved).withColumn(
        "__first", F.coalesce(F.max("__first").over(whole), F.min(FEED_DAY).over(whole))
    )
    # what was said last on a day on which something moved begins a version
    last = F.max_by(F.struct(*values, F.col("__first")), FEED_NUMBER).alias("__last")
    starts = marked.where("__moved").groupBy(entity, FEED_DAY).agg(last)
    following = F.lead(FEED_DAY).over(Window.partitionBy(entity).orderBy(FEED_DAY))
    spans = starts.select(
        entity,
        *[F.col(f"__last.{c}").alias(c) for c in values],
        F.col("__last.__first").alias(spec.first_seen),
        following.isNull().alias(spec.current),
        F.col(FEED_DAY).alias(begin),
        F.coalesce(following, open_end()).alias(end),
    )
    keyed = lookup(spans, replaced, {entity: entity, begin: begin}, {spec.key: spec.key}, "left", unique=True)
    keyed = stage(keyed.withColumn("__known", F.col(spec.key).isNotNull()), "spliced", "__known")
    fresh = keyed.where("not __known").select(*[c for c in spec.columns if c != spec.key])
    numbered = number_rows(fresh, [entity, begin], spec.key, start=last_key)
    versions = keyed.where("__known").select(*spec.columns).unionByName(numbered.select(*spec.columns))
    return Spliced(replaced, stage(versions, "versions"))


def _kept(dim: DataFrame, changes: DataFrame, spec: History, as_of: date) -> DataFrame:
    _, end = spec.validity
    acting = changes.where(F.col("action").isin(CHANGED, CORRECTED))
    values = [*spec.copied, *spec.tracked]
    take = {"action": "__action", **{c: f"__{c}" for c in values}}
    marked = lookup(
        dim, acting, {spec.business_key: spec.business_key}, take, "left", F.col(spec.current)
    )
    closed = F.col("__action").eqNullSafe(CHANGED)
    corrected = F.col("__action").eqNullSafe(CORRECTED)
    new: dict[str, Column] = {
        spec.current: F.col(spec.current) & ~closed,
        end: F.when(closed, F.lit(as_of)).otherwise(F.col(end)),
    }
    for c in values:
        new[c] = F.when(corrected, F.col(f"__{c}")).otherwise(F.col(c))
    return marked.withColumns(new).select(*spec.columns)


def _opened(
    dim: DataFrame, changes: DataFrame, spec: History, as_of: date, last_key: int | None
) -> DataFrame:
    begin, end = spec.validity
    rows = changes.where(F.col("action").isin(CHANGED, NEW)).select(
        *spec.feed_columns,
        spec.first_seen,
        F.lit(True).alias(spec.current),
        F.lit(as_of).alias(begin),
        open_end().alias(end),
    )
    last = (dim.agg(F.max(spec.key)).first()[0] or 0) if last_key is None else last_key
    return number_rows(rows, [spec.business_key], spec.key, start=last).select(*spec.columns)


def scd2_change_profile(changes: DataFrame, spec: History) -> DataFrame:
    """Counts of matched, changed (per tracked column, all at once) and new rows."""
    flags = [F.col(f"{c}_changed") for c in spec.tracked]
    every = flags[0]
    for flag in flags[1:]:
        every = every & flag
    known = F.col("action") != NEW
    return changes.agg(
        F.count_if(known).alias("matched"),
        *[F.count_if(f).alias(f"{c}_changed") for c, f in zip(spec.tracked, flags)],
        F.count_if(every).alias("all_changed"),
        F.count_if(F.col("action") == UNCHANGED).alias("unchanged"),
        F.count_if(~known).alias("new"),
    )


def scd2_history(dim: DataFrame, spec: History, entity: Column) -> DataFrame:
    """All versions of the entities ``entity`` selects, oldest first."""
    return dim.where(entity).orderBy(spec.business_key, spec.validity[0])


def scd2_version_counts(dim: DataFrame, spec: History) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(F.col(spec.current).cast("int")), F.lit(0)).alias("current_rows"),
    )


def scd2_not_one_current(dim: DataFrame, spec: History) -> DataFrame:
    """Entities without exactly one current version."""
    current = F.count_if(F.col(spec.current)).alias("current_versions")
    return dim.groupBy(spec.business_key).agg(current).where("current_versions <> 1")


def scd2_broken_chains(dim: DataFrame, spec: History) -> DataFrame:
    """Entities whose versions overlap or leave days uncovered.

    In an unbroken chain every end but the last is the beginning of exactly one
    other version. So each boundary date is counted as a beginning and as an end;
    no ordering within an entity is needed, and an entity with very many versions
    is spread over its dates.
    """
    begin, end = spec.validity
    edge = F.inline(
        F.array(
            F.struct(F.col(begin).alias("edge"), F.lit(1).alias("opens"), F.lit(0).alias("closes")),
            F.struct(F.col(end).alias("edge"), F.lit(0).alias("opens"), F.lit(1).alias("closes")),
        )
    )
    days = F.datediff(end, begin).cast("long")
    length = dim.select(spec.business_key, days.alias("days"), edge)
    per_edge = length.groupBy(spec.business_key, "edge").agg(
        F.sum("opens").alias("opens"),
        F.sum("closes").alias("closes"),
        F.sum(F.when(F.col("closes") == 1, F.col("days")).otherwise(0)).alias("days"),
        F.count_if(F.col("days") <= 0).alias("empty"),
    )
    chain = per_edge.groupBy(spec.business_key).agg(
        F.count_if((F.col("opens") == 1) & (F.col("closes") == 0)).alias("starts"),
        F.count_if((F.col("opens") == 0) & (F.col("closes") == 1)).alias("stops"),
        F.count_if((F.col("opens") > 1) | (F.col("closes") > 1)).alias("shared"),
        F.sum("empty").alias("empty"),
        F.sum("days").alias("covered_days"),
        F.datediff(F.max("edge"), F.min("edge")).cast("long").alias("span_days"),
    )
    covered, span = F.col("covered_days"), F.col("span_days")
    fault = (
        F.when(F.col("empty") > 0, "empty version")
        .when(covered > span, "overlap")
        .when(covered < span, "gap")
        .otherwise("overlap and gap")
    )
    broken = "starts <> 1 or stops <> 1 or shared > 0 or empty > 0"
    return chain.where(broken).select(
        spec.business_key, fault.alias("fault"), "covered_days", "span_days"
    )


def scd2_check(dim: DataFrame, spec: History, fact: DataFrame | None = None) -> DataFrame:
    """Violations per invariant: keys, one current version, validity, fact references."""
    (begin, end), current = spec.validity, F.col(spec.current)
    constraints = [
        Unique("key is unique", (spec.key,)),
        Unique("at most one current version", (spec.business_key,), current),
        RowRule("current means open", current != (F.col(end) == open_end())),
        RowRule("validity is not empty", F.col(begin) >= F.col(end)),
    ]
    report = constraint_report(dim, constraints)
    entities = {
        "exactly one current version": scd2_not_one_current(dim, spec),
        "unbroken validity": scd2_broken_chains(dim, spec),
    }
    for name, broken in entities.items():
        count = broken.agg(F.count(F.lit(1)).alias("violations"))
        report = report.unionByName(count.withColumn("constraint_name", F.lit(name)))
    if fact is not None:
        lost = orphan_rows(fact, spec.key, dim, spec.key).select(
            F.lit("fact finds its version").alias("constraint_name"), F.col("n").alias("violations")
        )
        report = report.unionByName(lost)
    return report
