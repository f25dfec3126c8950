"""Calendar rules: week keys, approximate months and the model's date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_MODES = ("calendar", "iso", "sunday")


def week_key(date: Column, mode: str = "calendar") -> tuple[Column, Column]:
    """(year, week) of a date.

    ``calendar`` pairs the ISO week with the calendar year, so 2027-01-01 is
    (2027, 53); ``iso`` uses the ISO year, (2026, 53); ``sunday`` counts
    Sunday-started weeks from January 1.
    """
    if mode == "calendar":
        return F.year(date), F.weekofyear(date)
    if mode == "iso":
        return F.extract(F.lit("YEAROFWEEK"), date), F.weekofyear(date)
    if mode == "sunday":
        new_year = F.make_date(F.year(date), F.lit(1), F.lit(1))
        # dayofweek() counts Sunday as 1.
        week = F.ceil((F.dayofyear(date) - 1 + F.dayofweek(new_year)) / 7)
        return F.year(date), week.cast("int")
    raise ValueError(f"mode must be one of {WEEK_MODES}")


def week_to_month(week: Column) -> Column:
    """The month in which a week number approximately falls."""
    month = F.floor((week - 1) / F.lit(4.34).cast("double")) + 1
    return F.least(F.lit(12), F.greatest(F.lit(1), month.cast("int")))


def date_parts(date: Column) -> dict[str, Column]:
    """Month, weekday with Monday as 0, and day of month."""
    return {"month": F.month(date), "day_of_week": F.weekday(date), "day": F.dayofmonth(date)}


def day_number(date: Column) -> Column:
    return F.unix_date(date)
