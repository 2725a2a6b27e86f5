"""Calendar parts. All integers come back as bigint so that schemas are uniform."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbers of the weekend, with 1 = Sunday.
WEEKEND_DAYS = (1, 7)
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def year(at: Column) -> Column:
    return F.year(at).cast("bigint")


def quarter(at: Column) -> Column:
    return F.quarter(at).cast("bigint")


def month(at: Column) -> Column:
    return F.month(at).cast("bigint")


def day(at: Column) -> Column:
    return F.dayofmonth(at).cast("bigint")


def hour(at: Column) -> Column:
    return F.hour(at).cast("bigint")


def day_of_week(at: Column) -> Column:
    """1 = Sunday to 7 = Saturday."""
    return F.dayofweek(at).cast("bigint")


def name_of_day(number: Column) -> Column:
    """The English name that belongs to a day number, 1 = Sunday. A lookup costs less than formatting."""
    return F.element_at(F.array(*(F.lit(name) for name in DAY_NAMES)), number.cast("int"))


def day_name(at: Column) -> Column:
    return name_of_day(day_of_week(at))


def is_weekend_day(number: Column) -> Column:
    return number.isin(*WEEKEND_DAYS)


def sunday_week(at: Column) -> Column:
    """Week of the year, 0 to 53: weeks start on Sunday and days before the first Sunday are in week 0."""
    return F.floor((F.dayofyear(at) + 7 - F.dayofweek(at)) / 7.0).cast("bigint")


def iso_year_week(at: Column) -> Column:
    """ISO year and week such as ``2021-W52``; the year is the ISO year, not the calendar year."""
    iso_year = F.extract(F.lit("YEAROFWEEK"), at).cast("string")
    return F.concat(iso_year, F.lit("-W"), F.lpad(F.weekofyear(at).cast("string"), 2, "0"))


def year_month(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


def month_start(at: Column) -> Column:
    return F.trunc(at, "month")


def instant(value: str) -> Column:
    """A timestamp constant without a zone, from ISO text."""
    return F.lit(value).cast("timestamp_ntz")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole elapsed seconds, truncated toward zero."""
    return (end - start).cast("interval second").cast("bigint")


def whole_minutes(seconds: Column) -> Column:
    """Whole minutes in a number of seconds, truncated toward zero."""
    return (seconds / 60.0).cast("bigint")
