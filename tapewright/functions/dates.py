"""Column functions on dates, and named date ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from tapewright.dims import RANGE_DAYS, RANGE_SINCE


def to_ts(c: Column) -> Column:
    """Timestamp, NULL when the text is none (a plain cast raises)."""
    return F.try_to_timestamp(c)


def to_day(c: Column) -> Column:
    return c.try_cast("date")


def day_gap(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def week_label(c: Column, compat: bool = False) -> Column:
    """``2024-W07``.  ``compat`` pairs the calendar year with the ISO week."""
    year = F.year(c) if compat else F.extract(F.lit("YEAROFWEEK"), c)
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(c).cast("string"), 2, "0"))


def stamp_label(c: Column, empty: str = "No data") -> Column:
    """``Jan 30 23:59 UTC``; ``empty`` when there is no value."""
    return F.coalesce(F.date_format(c, "MMM dd HH:mm 'UTC'"), F.lit(empty))


def since(c: Column, as_of: dt.date, days: int) -> Column:
    """True from ``days`` before ``as_of`` on."""
    return c >= F.lit(as_of - dt.timedelta(days=days))


def named_range(
    name: str, as_of: dt.date, custom: tuple[dt.date, dt.date] | None = None
) -> tuple[dt.date, dt.date]:
    """Start and end day of a preset, or of ``custom``."""
    if name in RANGE_DAYS:
        return as_of - dt.timedelta(days=RANGE_DAYS[name]), as_of
    if name in RANGE_SINCE:
        return RANGE_SINCE[name], as_of
    if name == "Custom" and custom:
        return custom
    raise ValueError(f"unknown range {name!r}")
