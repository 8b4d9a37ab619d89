"""Rounding, guarded ratios, scores and tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points per severity level; "none" has no entry.
SEVERITY_POINTS = {"minor": 1.0, "moderate": 2.0, "severe": 3.0}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def choose(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first case that holds."""
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), default)


def round_half_up(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double by way of a decimal, so that 0.575 gives 0.58 on any engine.

    A double of 2**53 or more has no digits behind the point and stays as it is, as do infinities.
    """
    value = _col(c).cast("double")
    return F.when(F.abs(value) < 2.0**53, F.round(value.try_cast("decimal(28,10)"), digits).cast("double")).otherwise(value)


def mean_money(total: Column, count: Column) -> Column:
    """Average of a decimal column from its already aggregated sum and count, to cents."""
    return F.round(F.try_divide(total, count), 2).cast("decimal(18,2)")


def rate(predicate: Column, digits: int = 4) -> Column:
    """Aggregate: share of rows where the predicate holds; an unknown predicate counts as no."""
    return round_half_up(F.avg(F.coalesce(predicate, F.lit(False)).cast("int")), digits)


def severity_points(c: Column | str, unlisted: float | None) -> Column:
    """Severity as a number. `unlisted` is what "none" and anything else maps to."""
    cases = [(_col(c) == level, F.lit(points)) for level, points in SEVERITY_POINTS.items()]
    return choose(cases, F.lit(unlisted).cast("double"))


def confidence(n: Column | str, smoothing: float) -> Column:
    """How far n observations are to be trusted: n / (n + smoothing)."""
    return _col(n) / (_col(n) + F.lit(float(smoothing)))


def shrink(score: Column, trust: Column | str, prior: float = 0.5) -> Column:
    """Pull a score towards the prior by the missing trust; no score gives the prior."""
    t = _col(trust)
    return F.coalesce(t * score + (1 - t) * F.lit(prior), F.lit(prior))


def unit_rating(c: Column | str, low: float = 1.0, high: float = 5.0) -> Column:
    """A star rating on the 0..1 scale."""
    return (_col(c) - low) / (high - low)


def unit_severity(c: Column | str) -> Column:
    """A mean severity on the 0..1 scale, 1 being free of trouble."""
    return 1.0 - _col(c) / max(SEVERITY_POINTS.values())


def recency(days: Column | str, decay_days: float) -> Column:
    return F.exp(-_col(days) / F.lit(float(decay_days)))


def weighted(weights: Mapping[str, float]) -> Column:
    return reduce(add, (F.lit(w) * F.col(name) for name, w in weights.items()))


def tier(c: Column | str, floors: Mapping[str, float], lowest: str) -> Column:
    """Name of the highest tier whose floor is reached. NULL stays NULL."""
    ranked = sorted(floors.items(), key=lambda named: -named[1])
    cases = [(_col(c) >= floor, F.lit(name)) for name, floor in ranked]
    return F.when(_col(c).isNotNull(), choose(cases, F.lit(lowest)))


def count_ids(c: Column, unique: bool) -> Column:
    """Count ids: a plain count where the grain makes the id unique, a distinct count elsewhere.

    Several distinct counts in one aggregate make Spark copy each row once per count, so a caller
    whose tables have one row per id says so.
    """
    return F.count(c) if unique else F.count_distinct(c)
