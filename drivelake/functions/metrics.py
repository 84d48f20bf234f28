"""Column helpers for Gold and DQ arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_in_year(d) -> Column:
    """365 or 366 for the calendar year of date ``d`` (Gregorian rule)."""
    d = _col(d)
    return F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31)))


def afr(failures, drive_days, year_days) -> Column:
    """annualized failure rate in percent, NULL when there are no drive-days.

    Operand order is failures / (drive_days / year_days) * 100, in double.
    """
    failures, drive_days, year_days = _col(failures), _col(drive_days), _col(year_days)
    rate = (failures.cast("double")
            / (drive_days.cast("double") / year_days.cast("double"))
            * F.lit(100.0))
    return F.when(drive_days > 0, rate).otherwise(F.lit(None).cast("double"))


def null_rate(null_count, total) -> Column:
    """share of NULLs; an empty scope counts as fully NULL (1.0)."""
    null_count, total = _col(null_count), _col(total)
    return F.when(total > 0, null_count.cast("double") / total.cast("double")).otherwise(F.lit(1.0))


def fixed6(x) -> Column:
    """Six-decimal text of a double, as in ``null_rate=0.000000``."""
    return F.format_string("%.6f", _col(x))
