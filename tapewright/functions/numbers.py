"""Column functions on numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def total(c: Column, exact: str | None = None) -> Column:
    """Sum as a double.

    The values are added up in their own type: decimals exactly, doubles as
    doubles, whose last digits depend on the order of rows.  ``exact`` names a
    decimal type to add up instead, for values that all fit it.
    """
    return F.sum(c.cast(exact) if exact else c).cast("double")


def mean(c: Column, exact: str | None = None) -> Column:
    return F.try_divide(total(c, exact), F.count(c))


def pct_change(new: Column, old: Column) -> Column:
    """Change in percent of the old value; NULL when that is 0 or missing."""
    return (F.try_divide(new, old) - 1) * 100


def pct_of_base(change: Column, base: Column) -> Column:
    """Change in percent of the size of the base; NULL when that is 0 or missing."""
    return F.try_divide(change, F.abs(base)) * 100


def direction(change: Column, zero: str = "flat") -> Column:
    """``up``, ``down``, or ``zero`` for no change; NULL stays NULL."""
    return (
        F.when(change > 0, "up").when(change < 0, "down").when(change == 0, F.lit(zero))
    )


def mega(c: Column) -> Column:
    return c / (1024 * 1024)


def share_of_limit(mb: Column, limit_mb: float = 1024) -> Column:
    """Percent of the limit, at most 100, one decimal."""
    return F.least(F.lit(100.0), F.round(mb / limit_mb * 100, 1))
