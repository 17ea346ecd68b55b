"""Course reserve reports: circulation of the items put on reserve for courses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioscope.functions.dates import FIRST_DAY, LAST_DAY, earlier_of, in_day_range, later_of, local_day
from biblioscope.functions.documents import json_text, text_fields, uuid_norm
from biblioscope.functions.text import call_number, ci_match, normalised
from biblioscope.operators.contract import sorted_by
from biblioscope.operators.history import latest_per_key, version_span, with_version_span
from biblioscope.operators.joins import bounds, likely, only, spread_join
from biblioscope.operators.spans import count_in_spans
from biblioscope.plans.derived import instance_ext, item_ext
from biblioscope.sources.staging import kept
from biblioscope.sources.tables import Tables

# Loan actions that count as a checkout, and the term of the permanent reserves.
CHECKOUT_ACTIONS = r"^(checkedout|checkedOutThroughOverride|renewed|renewedThroughOverride)$"
PERMANENT_TERM = "permanent"

RESERVE_DOCUMENT = text_fields("itemId", copiedItem=text_fields("title", "barcode", "callNumber"))
SHELF_DOCUMENT = text_fields(
    "volume", "copyNumber", effectiveCallNumberComponents=text_fields("prefix", "callNumber")
)
COURSE_DOCUMENT = text_fields("name", "courseNumber", "courseListingId", "departmentId")


def circ_stats_course_reserves(
    tables: Tables, circ_stat_course_name: str, start_date: dt.date = FIRST_DAY, end_date: dt.date = LAST_DAY
) -> DataFrame:
    """Loans in a period of every item ever on reserve for courses with a matching name.

    The output holds distinct (barcode, title, count), so courses and reserves only select
    items: they are reduced to distinct listings and items instead of being joined out.
    """
    listings = (
        tables["coursereserves_courses__t__"]
        .where(ci_match(F.col("name"), circ_stat_course_name))
        .select("course_listing_id")
        .distinct()
    )
    # Kept, as its size settles whether loans and items are filtered where they lie or shuffled.
    reserved = kept(
        tables["coursereserves_reserves__t__"]
        .select("course_listing_id", "item_id")
        .distinct()
        .join(listings, "course_listing_id", "left_semi")
        .select("item_id")
        .distinct()
    )
    daily = tables.get("loans_daily")
    if daily is None:
        loans = tables["loans_items"].where(F.col("loan_id").isNotNull() & in_day_range(F.col("loan_date"), start_date, end_date))
        counts = loans.groupBy("item_id").agg(F.count("loan_id").alias("circ_count"))
    else:
        counts = daily.where(in_day_range(F.col("day"), start_date, end_date)).groupBy("item_id").agg(F.sum("loans").alias("circ_count"))
    counts = counts.join(reserved, "item_id", "left_semi")
    holdings = tables["holdings_ext"].select(F.col("holdings_id").alias("holdings_record_id"), "instance_id")
    items = item_ext(
        tables, ["item_id", "barcode", "holdings_record_id"], only=reserved.withColumnRenamed("item_id", "id")
    )
    # Holdings and instances are cut to those of the reserved items before they are shuffled.
    holdings = only(holdings, items, "holdings_record_id")
    instances = only(instance_ext(tables, ["instance_id", "title"]), holdings, "instance_id")
    titles = spread_join(holdings, instances, "instance_id", "left").select("holdings_record_id", "title")
    rows = (
        spread_join(counts.join(items, "item_id", "left"), titles, "holdings_record_id", "left")
        .select(F.col("barcode").alias("item_barcode"), F.col("title").alias("instance_title"), "circ_count")
        .distinct()
    )
    return sorted_by(rows, "instance_title", "item_barcode", "circ_count")


def course_term_circ_stats(tables: Tables, term_name: str) -> DataFrame:
    """Checkouts and renewals of every item on reserve in a term, given its name or id.

    One row per reserve and course of its listing, over all versions of listings, courses
    and reserves; a listing that was moved to another term later still counts here.
    """
    wanted = normalised(F.lit(term_name))
    match = (normalised(json_text(F.col("jsonb"), "name")) == wanted) | (normalised(F.col("id")) == wanted)
    rows = _term_circ_stats(tables, "__", match)
    order = ["course_number", "course_name", "course_item_end", "item_title", "call_number"]
    return sorted_by(rows, *order, "item_id", "_reserve").drop("_reserve")


def perm_rsrv_curr_circ_stats(tables: Tables, term_name: str = PERMANENT_TERM) -> DataFrame:
    """The term report for the current versions of the permanent reserves (matched by name only)."""
    match = normalised(json_text(F.col("jsonb"), "name")) == normalised(F.lit(term_name))
    rows = _term_circ_stats(tables, "", match)
    order = ["course_name", "course_number", "course_item_end", "item_title", "call_number"]
    ordered = sorted_by(rows, *order, "item_id", "_reserve").drop("_reserve")
    return ordered.select("course_department", "course_name", "course_number", *ordered.columns[4:])


def _term_courses(tables: Tables, version: str, match: Column) -> DataFrame:
    """Courses of the listings that some version puts into a matching term, one row per course."""
    terms = (
        tables["coursereserves_terms"]
        .where(match)
        .select(F.col("id").alias("term_id"), json_text(F.col("jsonb"), "name").alias("course_term"))
    )
    versions = tables["coursereserves_courselistings" + version]
    listings = latest_per_key(
        versions.withColumn("term_id", json_text(F.col("jsonb"), "termId")).join(terms, "term_id"), ["id"]
    ).select(
        F.col("id").alias("clid"),
        "course_term",
        F.coalesce(json_text(F.col("jsonb"), "instructorObjects", 0, "name"), F.lit("")).alias("primary_instructor"),
        local_day(versions, "__start").alias("cls_start"),
        local_day(versions, "__end").alias("cls_end"),
    )
    courses = tables["coursereserves_courses" + version].withColumn("doc", F.from_json("jsonb", COURSE_DOCUMENT))
    tie = [c for c in ("__id",) if c in courses.columns]
    courses = courses.select(
        "id",
        "__start",
        *tie,
        F.col("doc.name").alias("course_name"),
        F.coalesce("doc.courseNumber", F.lit("")).alias("course_number"),
        F.col("doc.courseListingId").alias("clid"),
        F.col("doc.departmentId").alias("department_id"),
    )
    departments = tables["coursereserves_departments"].select(
        F.col("id").alias("department_id"), json_text(F.col("jsonb"), "name").alias("department")
    )
    return (
        latest_per_key(spread_join(courses, listings, "clid"), ["id"])
        .join(departments, "department_id", "left")
        .withColumn("course_department", F.coalesce("department", F.lit("")))
        .withColumnRenamed("id", "course_id")
        .drop("__start", *tie, "department_id", "department")
    )


def _reserve_items(tables: Tables, version: str, listings: DataFrame) -> DataFrame:
    """Newest version of every reserve on the given listings, with the days it was in force there."""
    relation = "coursereserves_reserves" + version
    reserves = tables[relation]
    tie = [c for c in ("__id",) if c in reserves.columns]
    columns = ["id", F.col("courselistingid").alias("clid"), "__start", *tie, "jsonb"]
    if tables.clustered(relation) == ["id"]:
        # The versions of a reserve lie together: spans and newest versions are found where they lie, in one pass
        # over the history, and the listings meet what is left.  The newest of a listing is the same before and after.
        versions = with_version_span(reserves, "id").select(*columns, "first_start", "last_end")
        spanned = spread_join(latest_per_key(_reserve_fields(versions), ["id", "clid"]), listings, "clid")
    else:
        # A listing may hold very many reserves: those that may be on one of these are parsed where they lie and cut to one
        # version before the shuffle, then meet the listings in a join that adaptive execution broadcasts or splits.
        versions = _reserve_fields(likely(reserves.select(*columns), "clid", listings, "clid"))
        latest = spread_join(latest_per_key(versions, ["id", "clid"]), listings, "clid")
        # Versions of a reserve are added up before their shuffle, whatever their listing: both sides of this join have
        # few rows of an id, and the spans are where it needs them.
        spanned = latest.join(version_span(reserves, "id"), "id", "left")
    first, last = local_day(spanned, "first_start"), local_day(spanned, "last_end")
    return spanned.select(
        F.col("id").alias("_reserve"),
        "clid",
        "item_id",
        "item_title",
        "item_barcode",
        "copied_call_number",
        later_of(F.col("cls_start"), first).alias("crr_start"),
        earlier_of(F.col("cls_end"), last).alias("crr_end"),
    )


def _reserve_fields(versions: DataFrame) -> DataFrame:
    document = versions.withColumn("doc", F.from_json("jsonb", RESERVE_DOCUMENT))
    return document.select(
        *[c for c in versions.columns if c != "jsonb"],
        F.col("doc.itemId").alias("item_id"),
        F.left("doc.copiedItem.title", F.lit(80)).alias("item_title"),
        F.col("doc.copiedItem.barcode").alias("item_barcode"),
        F.col("doc.copiedItem.callNumber").alias("copied_call_number"),
    )


def _checkouts(loans: DataFrame) -> DataFrame:
    """Item and local day of every checkout or renewal."""
    # json_tuple is not repeated when the filter moves down, so a document is parsed once.
    return (
        loans.where(F.col("id").isNotNull())
        .select("creation_date", F.json_tuple("jsonb", "itemId", "action").alias("item_id", "action"))
        .where(ci_match(F.col("action"), CHECKOUT_ACTIONS))
        .select("item_id", local_day(loans, "creation_date").alias("day"))
    )


def _day_bounds(first: Column, last: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Bounds on an instant for local days in [first, last]: two days of slack cover the zone shift, which keeps them on the bare column and so pushed down."""
    return F.date_sub(first, 2).cast(kind), F.date_add(last, 2).cast(kind)


def _checkouts_within(tables: Tables, reserves: DataFrame) -> DataFrame:
    """(item_id, day, times) of the checkouts that may fall into a reserve's span, from the daily counts where these are provided."""
    spans = reserves.where("crr_start <= crr_end")
    daily = tables.get("checkouts_daily")
    if daily is not None:
        within = F.col("day").between(*bounds(spans, F.col("crr_start"), F.col("crr_end")))
        return daily.where(within).select("item_id", "day", F.col("checkouts").alias("times"))
    loans = tables["loan__"]
    ends = _day_bounds(F.col("crr_start"), F.col("crr_end"), loans.schema["creation_date"].dataType)
    within = F.col("creation_date").between(*bounds(spans, *ends))
    return _checkouts(loans.where(within)).withColumn("times", F.lit(1))


def checkouts_daily(tables: Tables, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """(item_id, day, checkouts): checkouts and renewals of each item by local day, of all days or those in [first, last].

    Counts of days add up to those of any period, so the term reports read these instead of loan documents
    where they are provided under this name.
    """
    loans = tables["loan__"]
    if first is not None and last is not None:
        loans = loans.where(F.col("creation_date").between(*_day_bounds(F.lit(first), F.lit(last), loans.schema["creation_date"].dataType)))
    counted = _checkouts(loans).where(F.col("item_id").isNotNull() & F.col("day").isNotNull())
    if first is not None and last is not None:
        counted = counted.where(F.col("day").between(F.lit(first), F.lit(last)))
    return counted.groupBy("item_id", "day").agg(F.count(F.lit(1)).alias("checkouts"))


def loans_daily(tables: Tables, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """(item_id, day, loans): loans of each item by UTC day, of all days or those in [first, last]; read by the course report."""
    loans = tables["loans_items"].where(F.col("loan_id").isNotNull() & F.col("item_id").isNotNull() & F.col("loan_date").isNotNull())
    if first is not None and last is not None:
        loans = loans.where(in_day_range(F.col("loan_date"), first, last))
    return loans.groupBy("item_id", F.to_date("loan_date").alias("day")).agg(F.count(F.lit(1)).alias("loans"))


def _term_circ_stats(tables: Tables, version: str, match: Column) -> DataFrame:
    # Both kept sets are read several times below, and their true sizes settle the joins.
    courses = kept(_term_courses(tables, version, match))
    listings = courses.select("clid", "cls_start", "cls_end").distinct()
    reserves = kept(_reserve_items(tables, version, listings).withColumn("shelf_id", uuid_norm(F.col("item_id"))))

    # Live call numbers: documents are parsed where they lie, four fields of them are shuffled.
    number = "doc.effectiveCallNumberComponents"
    shelf = (
        tables["item"]
        .withColumn("doc", F.from_json("jsonb", SHELF_DOCUMENT))
        .select(
            F.col("id").alias("shelf_id"),
            F.col(f"{number}.prefix").alias("prefix"),
            F.col(f"{number}.callNumber").alias("number"),
            F.col("doc.volume").alias("volume"),
            F.col("doc.copyNumber").alias("copy"),
        )
    )
    shelf = only(shelf, reserves, "shelf_id")
    checkouts = count_in_spans(
        _checkouts_within(tables, reserves),
        reserves,
        on="item_id",
        by=["item_barcode", "clid"],
        day="day",
        start="crr_start",
        end="crr_end",
        count="loans",
        times="times",
    )
    return (
        spread_join(reserves, shelf, "shelf_id", "left")
        # Counts are per barcode but are met by item and listing: differing barcodes repeat the row.
        .join(checkouts.drop("item_barcode"), ["item_id", "clid"], "left")
        .join(courses.drop("cls_start", "cls_end"), "clid")
        .select(
            "course_term",
            "course_department",
            "course_number",
            "course_name",
            "primary_instructor",
            F.coalesce("loans", F.lit(0)).cast("bigint").alias("checkout_count"),
            "item_title",
            call_number(
                F.col("prefix"), F.col("number"), F.col("volume"), F.col("copy"), F.col("copied_call_number")
            ).alias("call_number"),
            "item_barcode",
            F.col("crr_start").alias("course_item_start"),
            F.col("crr_end").alias("course_item_end"),
            F.col("clid").alias("course_listing_id"),
            "course_id",
            "item_id",
            # Not shown: tells rows apart in the sort, so that equal ones need not share a task.
            "_reserve",
        )
    )
