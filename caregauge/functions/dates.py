"""Date helpers.

Inside the operators a date is handled as a day number (days since 1970-01-01):
integers can drive RANGE window frames and running sums, dates cannot.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(value: Column | str | datetime.date) -> Column:
    """Date (column, column name or literal) to day number."""
    if isinstance(value, datetime.date):
        value = F.lit(value)
    return F.unix_date(value)


def as_date(day: Column | str) -> Column:
    """Day number back to date."""
    column = F.col(day) if isinstance(day, str) else day
    return F.date_from_unix_date(column.cast("int"))


def add_days(start: Column | str, days: Column | int) -> Column:
    """``start + days``; fractional day counts are truncated, as a cast does."""
    return F.date_add(start, days if isinstance(days, int) else days.cast("int"))


def year_start(performance_yearstart: datetime.date, offset: int = 0) -> datetime.date:
    return datetime.date(performance_yearstart.year + offset, 1, 1)


def year_end(performance_yearstart: datetime.date, offset: int = 0) -> datetime.date:
    return datetime.date(performance_yearstart.year + offset, 12, 31)


def in_year(column: str, performance_yearstart: datetime.date, offset: int = 0) -> Column:
    """Calendar-year test as a range, so that it reaches the parquet scan."""
    return in_years(column, performance_yearstart, offset, offset)


def in_years(
    column: str, performance_yearstart: datetime.date, first: int = -1, last: int = 0
) -> Column:
    """``column`` lies in the calendar years ``first`` … ``last`` around the year."""
    return F.col(column).between(
        F.lit(year_start(performance_yearstart, first)),
        F.lit(year_end(performance_yearstart, last)),
    )


def inside_years(
    start: str,
    end: str,
    performance_yearstart: datetime.date,
    first: int = -1,
    last: int = 0,
) -> Column:
    """The whole span ``start`` … ``end`` lies inside those calendar years."""
    return (F.col(start) >= F.lit(year_start(performance_yearstart, first))) & (
        F.col(end) <= F.lit(year_end(performance_yearstart, last))
    )


def age_on(day: datetime.date, dob: str = "dob", days_per_year: float = 365) -> Column:
    """Fractional age: elapsed days over a fixed year length."""
    return F.datediff(F.lit(day), F.col(dob)) / F.lit(days_per_year)
