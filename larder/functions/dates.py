"""Calendar pieces of a timestamp, as dates and whole days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(ts: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(ts), "month")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def date_literal(text: str) -> Column:
    """A date from text; months and days may be written without leading zero."""
    year, month, day = (int(piece) for piece in text.split("-"))
    return F.lit(dt.date(year, month, day))
