"""Dates in file names, arguments and reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

FILE_DATE_PATTERN = r"(\d{4}_\d{2}_\d{2})"


def as_date(value: date | datetime | str | None) -> date | None:
    """A date from a date, a datetime or ISO text; None stays None ("today")."""
    if value is None:
        return None
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.date() if isinstance(value, datetime) else value


def day(value: date | datetime | str | None) -> Column:
    """Column for a day argument; None is the session's current date."""
    value = as_date(value)
    return F.current_date() if value is None else F.lit(value)


def file_date(path: Column) -> Column:
    """The YYYY_MM_DD in a path as a date; NULL when absent or not a calendar day."""
    return F.try_to_date(F.regexp_extract(path, FILE_DATE_PATTERN, 1), "yyyy_MM_dd")


def day_text(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd")
