"""Circulation reports on check-ins: activity, internal use and items never used."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.functions.dates import FIRST_DAY, LAST_DAY, in_midnight_range
from biblioscope.operators.history import current_rows
from biblioscope.operators.joins import bounds, only
from biblioscope.sources.staging import kept
from biblioscope.sources.tables import Tables

# The location the zero-use report looks at, and statuses before a check-in.
ZERO_USE_LOCATION = "59788294-9e3c-5b48-97d7-280067071b70"
CHECKED_OUT = "Checked out"
AVAILABLE = "Available"


def _of_items(check_ins: DataFrame, items: DataFrame) -> DataFrame:
    """The check-ins of ``items`` (item_id).

    The least and the greatest id bound the scan besides, by scalar subqueries on the bare column, so that check-ins
    that lie by item are read for these items' row groups alone.
    """
    least, greatest = bounds(items, F.col("item_id"), F.col("item_id"))
    return check_ins.where(F.col("item_id").between(least, greatest)).join(items, "item_id")


def count_circulation_history(
    tables: Tables, barcode_to_check: str, start_date: dt.date = FIRST_DAY, end_date: dt.date = LAST_DAY
) -> DataFrame:
    """Check-ins that ended a loan of one item. The end day counts up to its midnight only."""
    items = tables["item__t"].where(F.col("barcode") == barcode_to_check).select(F.col("id").alias("item_id"))
    returns = tables["check_in__t"].where(
        (F.col("item_status_prior_to_check_in") == CHECKED_OUT)
        & in_midnight_range(F.col("occurred_date_time"), start_date, end_date)
    )
    return _of_items(returns, items).select(
        F.col("id").alias("check_in_id"), F.to_date("occurred_date_time").alias("check_in_date")
    )


def count_internal_use(tables: Tables, barcode_to_check: str) -> DataFrame:
    """How often one item was checked in without a loan; one row, 0 when never.

    Only the item is restricted to its current version: every version of a check-in counts.
    """
    items = (
        current_rows(tables["item__t__"])
        .where(F.col("barcode") == barcode_to_check)
        .select(F.col("id").alias("item_id"))
    )
    uses = tables["check_in__t__"].where(F.col("item_status_prior_to_check_in") == AVAILABLE)
    return _of_items(uses, items).agg(F.count("id").cast("int").alias("internal_use_count"))


def zero_use_items(
    tables: Tables,
    start_date: dt.date = FIRST_DAY,
    end_date: dt.date = LAST_DAY,
    location_id: str = ZERO_USE_LOCATION,
) -> DataFrame:
    """Current items of one location without a check-in in the period.

    Intended semantics: the report this follows cannot run as written (its aliases are not in
    scope), so the period is applied to the check-ins that disqualify an item.
    """
    holdings = (
        tables["holdings_record__t__"]
        .where(F.col("permanent_location_id") == location_id.lower())
        .select(F.col("id").alias("holdings_record_id"), "instance_id")
    )
    titles = tables["instance__t__"].select(F.col("id").alias("instance_id"), "title")
    items = current_rows(tables["item__t__"]).select(F.col("id").alias("item_id"), "holdings_record_id")
    # The location's items first: check-ins of others are dropped where they lie, and an item with very
    # many check-ins reaches the anti join as one row.
    located = kept(items.join(holdings, "holdings_record_id").select("item_id", "instance_id"))
    check_ins = tables["check_in__t__"].where(in_midnight_range(F.col("occurred_date_time"), start_date, end_date))
    used = check_ins.select("item_id").join(located.select("item_id").distinct(), "item_id", "left_semi").distinct()
    return (
        located.join(used, "item_id", "left_anti")
        .join(only(titles, located, "instance_id"), "instance_id")
        .select("item_id", "title")
    )
