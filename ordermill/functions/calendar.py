"""Dates: parsing, day names, weekend flags, optional ranges, day scaffolds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DateLike = dt.date | str | None


def as_of_date(as_of: DateLike | Column) -> Column:
    """The reference day of a mart: a given date, or the current one."""
    if isinstance(as_of, Column):
        return as_of
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def parse_timestamp(df: DataFrame, name: str, naive_tz: str | None = None) -> Column:
    """ISO text to timestamp, NULL when unreadable; a column that is no text is a timestamp already.

    Text with an offset is taken at its word. Text without one is read in `naive_tz` when that is
    given, else in the session zone.
    """
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return c.cast("timestamp")
    parsed = F.try_to_timestamp(c)
    if naive_tz is None:
        return parsed
    # An offset, or a time with one, can follow a text only if it has none yet.
    suffixes = ("+00:00", "T00:00:00+00:00")
    naive = F.coalesce(*[F.expr(f"try_cast(concat(trim(`{name}`), '{x}') AS timestamp)") for x in suffixes]).isNotNull()
    moved = F.expr(f"cast(convert_timezone({_text(naive_tz)}, current_timezone(), try_cast(`{name}` AS timestamp_ntz)) AS timestamp)")
    return F.when(naive, moved).otherwise(parsed)


def _text(value: str) -> str:
    return "'" + value.replace("'", r"\'") + "'"


def day_name(c: Column | str) -> Column:
    return F.date_format(c, "EEEE")


def is_day(c: Column | str, days: Sequence[str]) -> Column:
    """True on the named days, False otherwise and for a missing date."""
    return F.coalesce(day_name(c).isin(list(days)), F.lit(False))


def in_date_range(df: DataFrame, c: str, first: DateLike = None, last: DateLike = None) -> DataFrame:
    """Optional inclusive bounds. Added only when set, so they reach the scan as plain filters."""
    if first is not None:
        df = df.filter(F.col(c) >= F.lit(str(first)).cast("date"))
    if last is not None:
        df = df.filter(F.col(c) <= F.lit(str(last)).cast("date"))
    return df


def days_between(bounds: DataFrame, first: str, last: Column | str, day: str) -> DataFrame:
    """One row per day from `first` to `last`; keys that start after `last` yield no row."""
    end = F.col(last) if isinstance(last, str) else last
    return (
        bounds.filter(F.col(first) <= end)
        .withColumn(day, F.explode(F.sequence(F.col(first), end)))
    )
