"""Small column helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F


def code(text: Column) -> Column:
    """Business codes compare without case or surrounding blanks."""
    return F.upper(F.trim(text))


def narrow_int(value: Column) -> Column:
    """BIGINT to INT that fails on overflow whatever the ANSI setting is."""
    fits = value.isNull() | value.between(-(2**31), 2**31 - 1)
    message = F.concat(F.lit("value does not fit INT: "), value.cast("string"))
    return F.when(fits, value.cast("int")).otherwise(F.raise_error(message).cast("int"))


_DECLARED = re.compile(r"(?P<kind>char|varchar|[a-z]+)(\((?P<size>[0-9,]+)\))?(?P<null> null)?")


def _declared(kind: str) -> re.Match:
    found = _DECLARED.fullmatch(kind)
    if found is None:
        raise ValueError(f"no declared type: {kind}")
    return found


def misfits(value: Column, kind: str) -> Column:
    """Whether a value is none of its declared type: too long, too short, too large or NULL."""
    declared = _declared(kind)
    if declared["kind"] == "char":
        wrong = F.length(value) != int(declared["size"])
    elif declared["kind"] == "varchar":
        wrong = F.length(value) > int(declared["size"])
    else:
        wrong = value.isNotNull() & value.try_cast(kind.removesuffix(" null")).isNull()
    return F.coalesce(wrong, F.lit(False)) if declared["null"] else F.coalesce(wrong, F.lit(True)) | value.isNull()


def as_declared(value: Column, kind: str) -> Column:
    """A value that fits as its declared type; text stays text."""
    text = _declared(kind)["kind"] in ("char", "varchar")
    return value if text else value.try_cast(kind.removesuffix(" null"))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def differs(left: Column, right: Column) -> Column:
    """Inequality where NULL is a value like any other."""
    return ~left.eqNullSafe(right)


def failed_names(rules: dict[str, Column]) -> Column:
    """Array of the names whose condition holds, empty when none does."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
