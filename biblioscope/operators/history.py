"""Operators on versioned (type-2) history tables: ``__id``, ``__start``, ``__end``, ``__current``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioscope.functions.dates import utc_instant

# Fixed value: ``__end`` of a version that is still open, in UTC.
OPEN_END = "9999-12-31 00:00:00"


def latest_per_key(df: DataFrame, keys: list[str], order: str = "__start") -> DataFrame:
    """The newest row of every key; a NULL ``order`` counts as newest.

    ``__id`` breaks ties; without it all other columns do, so that every run picks the same row.

    Written as row_number() = 1 so that Spark cuts every input partition to one row per
    key before the shuffle (WindowGroupLimit): a key holding much of the table is no hot spot.
    """
    rest = sorted(c for c in df.columns if c not in keys and c != order)
    ties = [F.desc_nulls_first(c) for c in (["__id"] if "__id" in rest else rest)]
    newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_first(order), *ties)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def version_span(df: DataFrame, key: str, first: str = "first_start", last: str = "last_end") -> DataFrame:
    """First ``__start`` and last ``__end`` over all versions of ``key``.

    A version without an end is the last one, so any NULL end makes the last end NULL.
    """
    open_ended = F.count(F.lit(1)) > F.count("__end")
    return df.groupBy(key).agg(
        F.min("__start").alias(first),
        F.when(~open_ended, F.max("__end")).alias(last),
    )


def with_version_span(df: DataFrame, key: str, first: str = "first_start", last: str = "last_end") -> DataFrame:
    """Every version with the ``version_span`` of its key beside it: for histories that lie by ``key``, where it needs no shuffle."""
    own = Window.partitionBy(key)
    open_ended = F.count(F.lit(1)).over(own) > F.count("__end").over(own)
    return df.withColumns({first: F.min("__start").over(own), last: F.when(~open_ended, F.max("__end").over(own))})


def current_rows(df: DataFrame) -> DataFrame:
    """Current versions: by the ``__current`` flag, else by an open ``__end``."""
    if "__current" in df.columns:
        return df.where(F.col("__current"))
    open_end = utc_instant(OPEN_END, df.schema["__end"].dataType)
    return df.where(F.col("__end").isNull() | (F.col("__end") == open_end))


def rows_at(df: DataFrame, instant: str) -> DataFrame:
    """Versions in force at an instant (UTC): begun by then, and not ended."""
    at = utc_instant(instant, df.schema["__start"].dataType)
    return df.where((F.col("__start") <= at) & (F.col("__end").isNull() | (F.col("__end") > at)))


def changed_between(df: DataFrame, after: str, upto: str) -> DataFrame:
    """Versions that began, or ended, behind the first instant and not behind the second (UTC).

    Both are bounds on bare columns: Parquet files that lie by time are skipped by their statistics, if the columns
    are TIMESTAMP written as microseconds (Spark pushes no bounds on TIMESTAMP_NTZ or INT96 down).
    """
    lo, hi = (utc_instant(x, df.schema["__start"].dataType) for x in (after, upto))
    began = (F.col("__start") > lo) & (F.col("__start") <= hi)
    return df.where(began | ((F.col("__end") > lo) & (F.col("__end") <= hi)))
