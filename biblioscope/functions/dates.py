"""Calendar days of instants, and comparisons of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The calendar the reports count in and the default report period.
LOCAL_ZONE = "US/Pacific"
FIRST_DAY = dt.date(2000, 1, 1)
LAST_DAY = dt.date(2099, 1, 1)


def local_day(df: DataFrame, name: str, zone: str = LOCAL_ZONE) -> Column:
    """Local calendar day of the instant column ``name``.

    TIMESTAMP_NTZ columns hold UTC wall clocks; TIMESTAMP columns are real instants.
    """
    ntz = isinstance(df.schema[name].dataType, T.TimestampNTZType)
    source = F.lit("UTC") if ntz else None
    return F.to_date(F.convert_timezone(source, F.lit(zone), F.col(name).cast("timestamp_ntz")))


def utc_instant(text: str, kind: T.DataType) -> Column:
    """A UTC wall clock as a literal of either timestamp type, in any session zone."""
    return F.lit(text if isinstance(kind, T.TimestampNTZType) else text + "Z").cast(kind)


def in_day_range(instant: Column, start: dt.date | None, end: dt.date | None) -> Column:
    """Whole days, both ends included; a NULL end matches nothing. Catalyst pushes this to the scan as an instant range."""
    return F.to_date(instant).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def in_midnight_range(instant: Column, start: dt.date | None, end: dt.date | None) -> Column:
    """From midnight of ``start`` to midnight of ``end``: of the end day only 00:00 counts.

    A NULL end matches nothing.
    """
    return (instant >= F.lit(start).cast("date")) & (instant <= F.lit(end).cast("date"))


def later_of(left: Column, right: Column) -> Column:
    """``left`` if it is later, else ``right``; unlike ``greatest`` a NULL ``right`` gives NULL."""
    return F.when(left > right, left).otherwise(right)


def earlier_of(left: Column, right: Column) -> Column:
    """``left`` if it is earlier, else ``right``; a NULL ``right`` gives NULL."""
    return F.when(left < right, left).otherwise(right)
