"""Accounting periods: ``MAR-26`` text and its first day."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_name(d: Column) -> Column:
    """Upper-case ``MMM-yy`` period of a date, e.g. ``MAR-26``."""
    return F.upper(F.date_format(d, "MMM-yy"))


def period_start(name: Column) -> Column:
    """First day of a ``MMM-yy`` period; ``yy`` always reads as 20yy (``JAN-95`` -> 2095-01-01).

    Names in another form (adjustment periods such as ``ADJ-25``) give NULL rather than
    failing the query, so they sort last.
    """
    return F.try_to_date(name, "MMM-yy")


def as_of_date(value) -> _dt.date | Column:
    """A reporting date from a date, a datetime (its date), ISO text, or a Column expression."""
    if value is None:
        raise ValueError("an as-of date is required")
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def shift_years(ts: Column, years: int) -> Column:
    """Date of ``ts`` moved by whole years (leap days kept when ``years`` is a multiple of 4)."""
    return F.add_months(F.to_date(ts), 12 * years)
