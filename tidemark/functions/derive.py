"""Derived columns: ages, bands, ratios, durations, flags and calendar parts.

Dates and times often arrive as text, so each function casts with ``try_cast``: text that is no date gives null
instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import as_col

DAYS_PER_YEAR = 365.25


def _date(c: Column | str) -> Column:
    return as_col(c).try_cast("date")


def _ts(c: Column | str) -> Column:
    return as_col(c).try_cast("timestamp")


def age_years(birth: Column | str, as_of) -> Column:
    """Whole years between ``birth`` and the fixed date ``as_of``."""
    return F.floor(F.datediff(F.lit(as_of).cast("date"), _date(birth)) / DAYS_PER_YEAR)


def tenure_years(start: Column | str, as_of, if_null: float | None = None) -> Column:
    """Years with one decimal since ``start``; null start gives ``if_null``."""
    years = F.round(F.datediff(F.lit(as_of).cast("date"), _date(start)) / DAYS_PER_YEAR, 1)
    return years if if_null is None else F.when(as_col(start).isNotNull(), years).otherwise(F.lit(if_null))


def band(
    c: Column | str,
    steps: Sequence[tuple[float, str]],
    last: str,
    side: str = "<=",
    floor: float | None = None,
    unknown: str | None = None,
) -> Column:
    """The label of the first step the value is ``<=`` (or ``<``) to, ``last`` beyond all of them.

    With ``unknown``, nulls and values below ``floor`` get that label. Without it null falls through to ``last``.
    """
    c = as_col(c)
    out = None
    if unknown is not None:
        bad = c.isNull() if floor is None else c.isNull() | (c < floor)
        out = F.when(bad, F.lit(unknown))
    for edge, label in steps:
        hit = (c <= edge) if side == "<=" else (c < edge)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(last))


def total(*cols: Column | str) -> Column:
    """Sum across columns; null as soon as one part is null."""
    return reduce(lambda a, b: a + b, [as_col(c) for c in cols])


def pct(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part / whole * 100``, 0.0 unless ``whole`` is positive."""
    part, whole = as_col(part), as_col(whole)
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def share_of_sum(used: Column | str, free: Column | str, digits: int = 4) -> Column:
    """``used / (used + free)``, 0.0 unless the sum is positive (a null part counts as not positive)."""
    used, free = as_col(used), as_col(free)
    return F.when((used + free) > 0, F.round(used / (used + free), digits)).otherwise(F.lit(0.0))


def elapsed(start: Column | str, end: Column | str, unit: str = "minute", digits: int = 1) -> Column:
    """Time from ``start`` to ``end`` in whole seconds turned into minutes, hours or days; null if either is null."""
    seconds = {"minute": 60, "hour": 3600, "day": 86400}[unit]
    return F.round((F.unix_timestamp(_ts(end)) - F.unix_timestamp(_ts(start))) / seconds, digits)


def business_hours_flag(
    day: Column | str, time: Column | str | None = None, hours: tuple[int, int] = (7, 17)
) -> Column:
    """1 on Monday to Friday when the hour lies in ``hours``, both ends included. ``time`` may be time-only text."""
    weekday = F.dayofweek(_date(day)).between(2, 6)
    hour = F.hour(_ts(day if time is None else time)).between(*hours)
    return F.when(weekday & hour, F.lit(1)).otherwise(F.lit(0))


def code_prefix(c: Column | str, n: int = 3) -> Column:
    """First ``n`` characters of a code."""
    return F.substring(as_col(c), 1, n)


def membership_flag(c: Column | str, values: Iterable) -> Column:
    """1 if the value is in the list, else 0 (null is 0)."""
    return F.when(as_col(c).isin(list(values)), F.lit(1)).otherwise(F.lit(0))


def rule_matrix_flag(key: Column | str, code: Column | str, matrix: Mapping[str, Sequence[str]]) -> Column:
    """1 if ``key`` has a list in ``matrix`` and ``code`` is not on it."""
    key, code = as_col(key), as_col(code)
    off_list = [(key == k) & ~code.isin(list(codes)) for k, codes in matrix.items()]
    return F.when(reduce(lambda a, b: a | b, off_list), F.lit(1)).otherwise(F.lit(0))


def threshold_status(
    value: Column | str,
    unit: Column | str,
    critical: Mapping[str, float],
    caution: float,
    labels: tuple[str, str, str] = ("Critico", "Precaucion", "Normal"),
) -> Column:
    """Status by a critical limit that depends on ``unit`` and a caution limit that does not.

    A unit without a limit of its own is never critical.
    """
    value, unit = as_col(value), as_col(unit)
    over = reduce(lambda a, b: a | b, [(unit == u) & (value >= limit) for u, limit in critical.items()])
    return (
        F.when(over, F.lit(labels[0])).when(value >= caution, F.lit(labels[1])).otherwise(F.lit(labels[2]))
    )


def line_total(quantity: Column | str, price: Column | str, digits: int = 2) -> Column:
    """``quantity * price`` rounded; null if either is null."""
    return F.round(as_col(price) * as_col(quantity), digits)


def date_parts(c: Column | str, names: Sequence[str] = ("_anio", "_mes", "_dia", "_hora")) -> dict[str, Column]:
    """Year, month, day and hour columns under as many of ``names`` as are given; null date, null parts."""
    c = as_col(c)
    makers = (F.year, F.month, F.dayofmonth, F.hour)
    return {name: make(c.try_cast("timestamp")) for name, make in zip(names, makers)}


def iso_week_parts(c: Column | str, calendar_year: bool = False) -> tuple[Column, Column]:
    """(year, ISO week). The year is the one the week belongs to; with ``calendar_year`` it is the date's own year,
    which puts 30 December 2024 into week 1 of 2024."""
    ts = as_col(c).try_cast("timestamp")
    year = F.year(ts) if calendar_year else F.extract(F.lit("YEAROFWEEK"), ts)
    return year.cast("int"), F.weekofyear(ts)
