"""Date keys and calendar columns, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

OPEN_END = "9999-12-31"  # fixed value: end of a validity interval still open
WEEKEND = ("Saturday", "Sunday")  # fixed value


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of(key: Column) -> Column:
    """The day of a yyyymmdd key."""
    whole = F.floor(key).cast("int")
    return F.make_date(F.floor(whole / 10000), F.floor(whole / 100) % 100, whole % 100)


def month_of(key: Column) -> Column:
    """yyyymm of a yyyymmdd key."""
    return F.floor(key / 100).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of one calendar day."""
    day_name = F.date_format(day, "EEEE")
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_name": day_name,
        "is_weekend": day_name.isin(*WEEKEND),
    }
