"""Date columns and keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd"


def header_date(text: Column) -> Column:
    """``M/D/YY`` text to a date in the years 2000-2099, ``M/D/YYYY`` to that year; null for other texts."""
    parts = F.regexp_extract(text, r"^(\d{1,2}/\d{1,2}/)(\d{2}|\d{4})$", 1)
    year = F.regexp_extract(text, r"^(\d{1,2}/\d{1,2}/)(\d{2}|\d{4})$", 2)
    full = F.concat(parts, F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year))
    return F.try_to_date(F.nullif(full, F.lit("")), "M/d/yyyy")


def parse_header(name: str) -> dt.date | None:
    """D1 for one column *name*; None when the name is not a date."""
    parts = name.split("/")
    if len(parts) != 3 or not all(p.isascii() and p.isdigit() for p in parts):
        return None
    if not all(len(p) in sizes for p, sizes in zip(parts, ((1, 2), (1, 2), (2, 4)))):
        return None
    month, day, year = (int(p) for p in parts)
    try:
        return dt.date(year + 2000 if len(parts[2]) == 2 else year, month, day)
    except ValueError:
        return None


def dateid(date: Column) -> Column:
    """Date to the integer key ``yyyyMMdd``."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("long")


def first_of_month(year: Column, month: Column) -> Column:
    """D3: (year, month) to the first day of that month."""
    return F.make_date(year, month, F.lit(1))


def first_dateid(year: Column, month: Column) -> Column:
    """(year, month) to the date key of its first day."""
    return (year * 10000 + month * 100 + 1).cast("long")


def month_name(date: Column) -> Column:
    """English month name."""
    return F.date_format(date, "MMMM")


def period_date(year: Column, period: Column) -> Column:
    """(2020, ``M03``) to 2020-03-01; null for anything that is no month (``M13``)."""
    month = F.when(is_month_period(period), F.substring(period, 2, 2).cast("int"))
    return F.make_date(year.cast("int"), month, F.lit(1))


def is_month_period(period: Column) -> Column:
    """F8: string range that keeps M01-M12 and leaves the annual M13 out."""
    return period.between("M01", "M12")


def iso_text(date: Column) -> Column:
    """Date to ``yyyy-mm-dd`` text."""
    return F.date_format(date, ISO_PATTERN)


def iso_date(text: Column) -> Column:
    """``yyyy-mm-dd`` text to date."""
    return F.to_date(text, ISO_PATTERN)


def days_between(start: Column, end: Column) -> Column:
    """Array of the days in the half-open interval ``[start, end)``."""
    none = F.array().cast("array<date>")
    return F.when(start < end, F.sequence(start, F.date_sub(end, 1))).otherwise(none)


def same_day(a: Column, b: Column) -> Column:
    """Equal calendar day, time of day ignored."""
    return F.to_date(a) == F.to_date(b)


def same_month(a: Column, b: Column) -> Column:
    """Equal calendar month, day and time ignored."""
    return F.trunc(a, "MM") == F.trunc(b, "MM")


def month_number(date: Column) -> Column:
    """Months since year 0: a bucket that grows with the date."""
    return F.year(date) * 12 + F.month(date) - 1


def month_of(day: dt.date) -> int:
    """As ``month_number``, for one date."""
    return day.year * 12 + day.month - 1
