"""Dates of order lines and hours of timetables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktally.constants import LONG_DATE, SHORT_DATE, SORTABLE_DATE
from sparktally.functions.numbers import as_column


def parse_short_date(value: Column | str, as_of: datetime.date | None = None) -> Column:
    """A ``M/d/yy`` or ``M/d/yyyy`` text as a date; NULL if it is neither.

    A two-digit year lies at most 20 years after ``as_of`` (today by default) and
    otherwise in the century before, so 99 is 1999.
    """
    text = F.trim(as_column(value))
    today = F.current_date() if as_of is None else F.lit(as_of)
    short = F.try_to_date(text, SHORT_DATE)
    short = F.when(short > F.add_months(today, 240), F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(short, F.try_to_date(text, LONG_DATE))


def sortable_date(value: Column | str) -> Column:
    """A date as ``yyyy/MM/dd`` text, whose text order is the date order."""
    return F.date_format(as_column(value), SORTABLE_DATE)


def hour_prefix(value: Column | str) -> Column:
    """The hour of ``hh:mm:ss`` as text; a service day may have hours past 23."""
    return F.substring_index(as_column(value), ":", 1)


def field(value: Column | str, separator: str, number: int) -> Column:
    """Field ``number``, from 1, of delimited text; empty where there is none."""
    return F.split_part(as_column(value), F.lit(separator), F.lit(number))
