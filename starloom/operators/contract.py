"""Data contracts: declared once, compiled to native predicates.

Rules on single rows are checked in one pass. Only uniqueness and references
need a shuffle, and both count per value first.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starloom.functions.columns import failed_names
from starloom.operators.checks import (
    RowRule,
    constraint_report,
    grain_check,
    orphan_rows,
    orphans,
    side_by_side,
)
from starloom.operators.joins import lookup
from starloom.session import stage


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool = False
    allowed: tuple[str, ...] | None = None
    minimum: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    key: str


@dataclass(frozen=True)
class CrossRule:
    """A condition, in SQL, that no row may meet together with its parent's row.

    ``on`` maps columns to the parent's key, ``take`` the parent's columns to the
    names under which ``broken`` knows them.
    """

    name: str
    parent: str
    on: dict[str, str]
    take: dict[str, str]
    broken: str


@dataclass(frozen=True)
class Contract:
    """Columns with their rules, further row rules, keys, references, rules with parents.

    ``row_rules`` maps a name to the condition, in SQL, no row may meet.
    """

    columns: tuple[ContractColumn, ...]
    unique: tuple[str, ...] = ()
    references: tuple[ForeignKey, ...] = ()
    row_rules: dict[str, str] = field(default_factory=dict)
    cross_rules: tuple[CrossRule, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def named_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns only, so further ones cannot reach a consumer."""
    return df.select(*contract.names)


# fixed value: the form of a date in a feed
_DATE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$"


def _no_value(text: Column, kind: str) -> Column:
    """Whether a text is no value of its type, or one that the type would round or guess."""
    value = text.try_cast(kind)
    lossy = F.lit(False)
    if kind.startswith("decimal"):
        lossy = text.try_cast("decimal(38,18)") != value
    elif kind == "date":
        lossy = ~text.rlike(_DATE)
    return text.isNotNull() & (value.isNull() | F.coalesce(lossy, F.lit(False)))


def check_types(raw: DataFrame, contract: Contract) -> DataFrame:
    """Per column: is it there, and how many texts are no value of its type.

    ``raw`` holds every column as text.
    """
    present = [c for c in contract.columns if c.name in raw.columns]
    bad = [
        F.count_if(_no_value(F.col(c.name), c.type)).alias(f"b_{c.name}") for c in present
    ]
    row = raw.agg(F.count(F.lit(1)).alias("__rows"), *bad)

    def entry(name: str, kind: str, status: str, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("declared_type"),
            F.lit(status).alias("status"),
            n.cast("long").alias("bad_values"),
        )

    entries = []
    for c in contract.columns:
        if c in present:
            entries.append(entry(c.name, c.type, "present", F.col(f"b_{c.name}")))
        else:
            entries.append(entry(c.name, c.type, "missing", F.lit(0)))
    for name in raw.columns:
        if name not in contract.names:
            entries.append(entry(name, "undeclared", "extra", F.lit(0)))
    return row.select(F.inline(F.array(*entries)))


class Conformed(NamedTuple):
    typed: DataFrame
    quarantined: DataFrame


class MissingColumnsError(ValueError):
    """A delivery lacks columns of its contract."""


def conform(raw: DataFrame, contract: Contract) -> Conformed:
    """Text cast to the contract's types, row by row.

    A row with a text that is no value of its column's type, or one that the type would
    round, is set aside as delivered with the reasons of every such column. Columns that
    the contract does not name are left behind.
    """
    absent = [c.name for c in contract.columns if c.name not in raw.columns]
    if absent:
        raise MissingColumnsError(f"no column {', '.join(absent)}")
    wrong = {f"{c.name} is no {c.type}": _no_value(F.col(c.name), c.type) for c in contract.columns}
    reasons = failed_names(wrong)
    values = [F.col(c.name).try_cast(c.type).alias(c.name) for c in contract.columns]
    # the delivered text is kept for the rows that are set aside only
    text = F.when(F.size(reasons) > 0, F.struct(*contract.names)).alias("__text")
    judged = raw.select(*values, text, reasons.alias("reasons"), (F.size(reasons) > 0).alias("wrong"))
    stored = stage(judged, "conformed", "wrong")
    return Conformed(
        stored.where("not wrong").select(*contract.names), stored.where("wrong").select("__text.*", "reasons")
    )


def not_null_rules(contract: Contract) -> dict[str, Column]:
    return {f"{c.name} is null": F.col(c.name).isNull() for c in contract.columns if not c.nullable}


def domain_rules(contract: Contract) -> dict[str, Column]:
    return {
        f"{c.name} not allowed": ~F.col(c.name).isin(*c.allowed)
        for c in contract.columns
        if c.allowed is not None
    }


def range_rules(contract: Contract) -> dict[str, Column]:
    return {
        f"{c.name} below {c.minimum}": F.col(c.name) < c.minimum
        for c in contract.columns
        if c.minimum is not None
    }


def row_rules(contract: Contract) -> dict[str, Column]:
    return {
        **not_null_rules(contract),
        **domain_rules(contract),
        **range_rules(contract),
        **{name: F.expr(broken) for name, broken in contract.row_rules.items()},
    }


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule, in one pass; a rule on NULL is not violated."""
    report = constraint_report(df, [RowRule(n, c) for n, c in rules.items()])
    return report.withColumnRenamed("constraint_name", "rule")


def check_unique(df: DataFrame, contract: Contract) -> DataFrame:
    return grain_check(df, list(contract.unique))


def check_references(
    df: DataFrame, contract: Contract, parents: dict[str, DataFrame]
) -> DataFrame:
    """One row: rows per reference that point nowhere."""
    return side_by_side(
        {f.column: orphan_rows(df, f.column, parents[f.parent], f.key) for f in contract.references}
    )


def check_cross_table(
    df: DataFrame,
    parent: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    violated: Column,
    large: bool = False,
) -> DataFrame:
    """Joined rows and those that break a rule over both tables."""
    joined = lookup(df, parent, on, take, large=large)
    return joined.agg(
        F.count(F.lit(1)).alias("checked_rows"), F.count_if(violated).alias("violations")
    )


class Verdict(NamedTuple):
    accepted: DataFrame
    quarantined: DataFrame
    alerts: DataFrame


def mark(df: DataFrame, contract: Contract, parents: dict[str, DataFrame]) -> DataFrame:
    """Every row with ``reasons``, the rules it breaks.

    Repeated keys and dangling references are found per value, and only those
    values are joined back to the rows.
    """
    marked = df
    extra: dict[str, Column] = {}
    if contract.unique:
        keys = check_unique(df, contract).select(*contract.unique, F.lit(True).alias("hit"))
        repeated = stage(keys, "repeated")
        on = {c: c for c in contract.unique}
        marked = lookup(marked, repeated, on, {"hit": "__repeated"}, "left", keys_of=df)
        extra[f"{', '.join(contract.unique)} repeated"] = F.col("__repeated")
    for f in contract.references:
        values = orphans(df, f.column, parents[f.parent], f.key)
        lost = stage(values.select(f.column, F.lit(True).alias("hit")), "lost")
        hit = {"hit": f"__lost_{f.column}"}
        marked = lookup(marked, lost, {f.column: f.column}, hit, "left", keys_of=df)
        extra[f"{f.column} not in {f.parent}"] = F.col(f"__lost_{f.column}")
    for rule in contract.cross_rules:
        marked = lookup(marked, parents[rule.parent], rule.on, rule.take, "left", keys_of=df)
        extra[rule.name] = F.expr(rule.broken)
    reasons = failed_names({**row_rules(contract), **extra})
    return marked.withColumn("reasons", reasons).select(*df.columns, "reasons")


def alerts(marked: DataFrame) -> DataFrame:
    """Rows per broken rule, for the feed's owner."""
    return (
        marked.select(F.explode("reasons").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def apply_contract(
    df: DataFrame, contract: Contract, parents: dict[str, DataFrame], mode: str = "quarantine"
) -> Verdict:
    """Split a batch by the contract.

    ``quarantine`` sets aside the rows that break a rule, ``reject`` the whole
    batch as soon as one row does.
    """
    if mode not in ("quarantine", "reject"):
        raise ValueError(f"mode is quarantine or reject, not {mode}")
    judged = mark(df, contract, parents).withColumn("broken", F.size("reasons") > 0)
    marked = stage(judged, "marked", "broken")
    broken = marked.where("broken").drop("broken")
    accepted = marked.where("not broken").select(*df.columns)
    if mode == "reject" and not broken.isEmpty():
        return Verdict(accepted.where(F.lit(False)), marked.drop("broken"), alerts(broken))
    return Verdict(accepted, broken, alerts(broken))


ZONE = "Asia/Kolkata"  # fixed value: the delivery times below are local there
DUE_HOUR = 6  # fixed value: a feed has landed by then
LIMIT_HOUR = 8  # fixed value: later than this the day's refresh waits


def local_time(instant: Column, zone: str = ZONE) -> Column:
    """A timestamp as wall-clock time in the zone the delivery times are given in."""
    return F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz"))


def arrivals_of(files: DataFrame, feed: str, business_date: Column) -> DataFrame:
    """Arrivals of a file feed: when each file was last written."""
    landed = local_time(F.col("_metadata.file_modification_time")).alias("landed_at")
    return files.select(F.lit(feed).alias("feed"), business_date.alias("business_date"), landed)


def expected_days(feeds: DataFrame, first: date, last: date) -> DataFrame:
    """Every feed on every day from ``first`` to ``last``, delivered or not.

    ``feeds`` lists what the day needs under ``feed``. Neither the list nor the days
    come from what arrived, so a feed that never came is missing all the same.
    """
    days = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("business_date")
    return feeds.select("feed").distinct().select("feed", days)


def freshness(
    arrivals: DataFrame,
    expected: DataFrame,
    due_hour: int = DUE_HOUR,
    limit_hour: int = LIMIT_HOUR,
) -> DataFrame:
    """Status of every expected delivery, and whether the refresh must wait."""
    first = arrivals.groupBy("feed", "business_date").agg(F.min("landed_at").alias("landed_at"))
    midnight = F.col("business_date").cast("timestamp_ntz")
    landed = F.col("landed_at")
    status = (
        F.when(landed.isNull(), "missing")
        .when(landed <= midnight + F.make_dt_interval(hours=F.lit(due_hour)), "on_time")
        .when(landed <= midnight + F.make_dt_interval(hours=F.lit(limit_hour)), "late")
        .otherwise("pause")
    )
    return (
        expected.join(first, ["feed", "business_date"], "left")
        .withColumn("status", status)
        .withColumn("paused", F.col("status").isin("pause", "missing"))
    )


MAX_DROP = 0.01  # fixed value: larger drops in row count raise an alert


def volume_status(today: Column, prior: Column, max_drop: float) -> Column:
    return (
        F.when(today == 0, "missing")
        .when(prior.isNull(), "first")
        .when(today >= prior, "ok")
        .when((prior - today).cast("double") / prior > max_drop, "alert")
        .otherwise("decreased")
    )


def volume_check(today: DataFrame, prior: DataFrame, max_drop: float = MAX_DROP) -> DataFrame:
    """Row counts of two snapshots; the count is not expected to fall."""
    one = F.count(F.lit(1)).alias("n")
    both = side_by_side({"prior_rows": prior.agg(one), "today_rows": today.agg(one)})
    return both.withColumn(
        "status", volume_status(F.col("today_rows"), F.col("prior_rows"), max_drop)
    )


def volume_by_day(
    rows: DataFrame, day: str, first: date, last: date, max_drop: float = MAX_DROP
) -> DataFrame:
    """Every day's delivery from ``first`` to ``last`` against the last one before it.

    A day without rows is missing, and the next is compared with the day before it.
    """
    counts = rows.groupBy(F.col(day).alias("business_date")).agg(
        F.count(F.lit(1)).alias("today_rows")
    )
    days = rows.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("business_date")
    )
    every = days.join(counts, "business_date", "left").fillna(0, ["today_rows"])
    # one row per day of the calendar
    before = Window.orderBy("business_date").rowsBetween(Window.unboundedPreceding, -1)
    delivered = F.when(F.col("today_rows") > 0, F.col("today_rows"))
    return every.withColumn("prior_rows", F.last(delivered, True).over(before)).withColumn(
        "status", volume_status(F.col("today_rows"), F.col("prior_rows"), max_drop)
    )


def new_values(df: DataFrame, contract: Contract) -> DataFrame:
    """Values outside the allowed ones, with their row counts."""
    fields = [
        F.struct(F.lit(c.name).alias("column_name"), F.col(c.name).alias("value"))
        for c in contract.columns
        if c.allowed is not None
    ]
    counts = df.select(F.inline(F.array(*fields))).groupBy("column_name", "value")
    unknown = F.lit(False)
    for c in contract.columns:
        if c.allowed is not None:
            unknown |= (F.col("column_name") == c.name) & ~F.col("value").isin(*c.allowed)
    return counts.agg(F.count(F.lit(1)).alias("rows")).where(unknown)


def schema_drift(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str, bool]]:
    """Kind, column, detail and whether it breaks consumers, per changed column."""
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    changes = []
    for name in sorted(before.keys() | after.keys()):
        if name not in before:
            optional = after[name].nullable
            detail = after[name].dataType.simpleString() + ("" if optional else " not null")
            changes.append(("column added", name, detail, not optional))
        elif name not in after:
            changes.append(("column removed", name, before[name].dataType.simpleString(), True))
        elif before[name].dataType != after[name].dataType:
            kinds = [f.dataType.simpleString() for f in (before[name], after[name])]
            changes.append(("column retyped", name, " to ".join(kinds), True))
    return changes


def classify_drift(old: DataFrame, new: DataFrame, contract: Contract) -> DataFrame:
    """What changed between two batches and whether consumers break.

    A new optional column does not; a removed, renamed or retyped column and a
    new value of a closed list do.
    """
    columns = new.sparkSession.createDataFrame(
        schema_drift(old.schema, new.schema),
        "change string, column_name string, detail string, breaking boolean",
    ).withColumn("rows", F.lit(None).cast("long"))
    listed = tuple(c for c in contract.columns if c.allowed is not None and c.name in new.columns)
    if not listed:
        return columns
    values = new_values(new, Contract(listed)).select(
        F.lit("value added").alias("change"),
        "column_name",
        F.col("value").alias("detail"),
        F.lit(True).alias("breaking"),
        "rows",
    )
    return columns.unionByName(values)
