"""Dates, reporting periods and quarter bounds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_date(c: Column) -> Column:
    """Text of the form yyyy-MM-dd to date; anything else becomes null.

    A cast parses several times faster than a pattern does, but also takes
    looser spellings: the shape is tested first.
    """
    dashes = (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    return F.when((F.char_length(c) == 10) & dashes, c.try_cast("date"))


def exercise_months(start: Column, end: Column) -> Column:
    """Whole months covered by an accounting exercise."""
    return F.round(F.months_between(end, start))


def quarter_end(year: Column, quarter: Column) -> Column:
    """Last day of a calendar quarter."""
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def quarter_end_pinned(quarter: Column, year: int = 2022) -> Column:
    """Quarter end in one given year, whatever year the row belongs to."""
    return quarter_end(F.lit(year), quarter)


def quarter_start(end: Column) -> Column:
    """The date two months before a quarter end, day of month kept."""
    return F.add_months(end, -2)


def fetch_window(day: Column) -> tuple[Column, Column]:
    """Half-open window (day before, day after) around an execution date."""
    return F.date_sub(day, 1), F.date_add(day, 1)
