"""Rollups that keep to a fact's declared measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.model import Fact


class NonAdditiveError(ValueError):
    """A sum was asked of something that does not add up."""


def rollup(fact: DataFrame, spec: Fact, by: list[str | Column], measures: list[str]) -> DataFrame:
    """Row count, additive sums and ratios of ``fact`` per ``by``.

    Additive measures are summed. A ratio is the quotient of two sums at this
    very grain. Anything else cannot be rolled up.
    """
    additive = {m.name: m for m in spec.measures if m.additive}
    ratios = {r.name: r for r in spec.ratios}
    unknown = [m for m in measures if m not in additive and m not in ratios]
    if unknown:
        raise NonAdditiveError(f"cannot be summed over {spec.name}: {', '.join(unknown)}")

    parts = set()
    for name in measures:
        if name in ratios:
            parts |= {ratios[name].numerator, ratios[name].denominator} - {None}
        else:
            parts.add(name)
    not_additive = sorted(p for p in parts if p not in additive)
    if not_additive:
        raise NonAdditiveError(f"parts of a ratio must add up: {', '.join(not_additive)}")

    sums = fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("bookings"),
        *[F.sum(additive[p].column).alias(f"sum_{p}") for p in sorted(parts)],
    )
    for name in measures:
        if name in ratios:
            top = F.col(f"sum_{ratios[name].numerator}")
            under = ratios[name].denominator
            bottom = F.col(f"sum_{under}" if under else "bookings")
            sums = sums.withColumn(
                name, F.try_divide(top.cast("double"), bottom.cast("double"))
            )
        else:
            sums = sums.withColumn(name, F.col(f"sum_{name}"))
    return sums.drop(*[f"sum_{p}" for p in parts])
