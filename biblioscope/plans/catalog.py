"""The reports by name: their form (texts and parameters), output types and how to run them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from biblioscope.operators.contract import collated, conform
from biblioscope.plans import circulation, courses, derived, inventory, notes
from biblioscope.sources.staging import keeping
from biblioscope.sources.tables import Tables


@dataclass(frozen=True)
class Parameter:
    name: str
    display_name: str
    type: str
    required: bool


@dataclass(frozen=True)
class Report:
    name: str
    function: Callable[..., DataFrame]
    schema: str
    display_name: str
    description: str
    instructions: str
    parameters: tuple[Parameter, ...] = ()
    # Whether the report has a form that a client can list.
    listed: bool = True


def _text(name: str, display_name: str, required: bool = True) -> Parameter:
    return Parameter(name, display_name, "text", required)


_PERIOD = (
    Parameter("start_date", "Earliest date of circulation activity", "date", False),
    Parameter("end_date", "Latest date of circulation activity", "date", False),
)
_NO_INPUT = "Takes no input."

_TERM_TAIL = """
    primary_instructor string, checkout_count bigint, item_title string, call_number string,
    item_barcode string, course_item_start date, course_item_end date,
    course_listing_id string, course_id string, item_id string
"""

_ALL = [
    Report(
        "circ_stats_course_reserves",
        courses.circ_stats_course_reserves,
        "item_barcode string, instance_title string, circ_count decimal(38,0)",
        "Circulation of a course's reserve items in a date range",
        "Counts the loans of every item that was on reserve for courses with a matching name.",
        "Enter the course name, or part of it, and the dates to count between.",
        (_text("circ_stat_course_name", "Course Name"), *_PERIOD),
    ),
    Report(
        "class_list",
        notes.class_list,
        "item_barcode string, location_code string, location_name string, item_call_number string,"
        " instance_title string, item_note string",
        "Class list by item note",
        "Lists the items whose notes match a search text, with location and call number.",
        "Enter a search text for the item note; without one the list is empty.",
        (_text("note_string", "Item Note Contains", required=False),),
    ),
    Report(
        "count_circulation_history",
        circulation.count_circulation_history,
        "check_in_id string, check_in_date date",
        "Circulation history of an item",
        "Lists the check-ins that ended a loan of the item with the given barcode.",
        "Enter an item barcode and the dates to look between.",
        (_text("barcode_to_check", "Item Barcode"), *_PERIOD),
    ),
    Report(
        "count_internal_use",
        circulation.count_internal_use,
        "internal_use_count int",
        "Internal use count of an item",
        "Counts the check-ins of the item with the given barcode that no loan preceded.",
        "Enter an item barcode.",
        (_text("barcode_to_check", "Item Barcode"),),
    ),
    Report(
        "course_term_circ_stats",
        courses.course_term_circ_stats,
        "course_term string, course_department string, course_number string, course_name string," + _TERM_TAIL,
        "Circulation counts of course reserve items by term",
        "Gathers all items on reserve in a term and counts their checkouts and renewals. Any term"
        " can be asked for, the permanent one included.",
        "Enter a term name or its id.",
        (_text("term_name", "Term name (or id)"),),
    ),
    Report(
        "display_inventory_curriculum_collection",
        inventory.display_inventory_curriculum_collection,
        "location string, index_title string, contributor_name string, call_number string, volume string,"
        " copy_number string, link string, item_barcode string, item_id string, holdings_id string",
        "Inventory of the Curriculum Collection",
        "Lists the items under a call number prefix with title, primary contributor and catalogue link.",
        "Enter the call number prefix; 'Curr' lists the whole collection.",
        (_text("i_call_number_prefix", "Call Number Prefix"),),
    ),
    Report(
        "duplicate_oclc_numbers",
        inventory.duplicate_oclc_numbers,
        "dup_count decimal(38,0), id_type string, oclc_number string",
        "Duplicate OCLC numbers",
        "Lists OCLC numbers that several instances share, known duplicates excluded.",
        "Run it, correct the instances, and run it again.",
    ),
    Report(
        "googlebooknotes",
        notes.googlebooknotes,
        "discovery_suppress string, item_hrid string, holdings_hrid string, item_location string, barcode string,"
        " formerids string, call_number string, shelving_order string, material_type string, title string,"
        " note_type_name string, note string, staff_only string, note_ordinality int",
        "Items with a Google Books note",
        "Lists every item note of the Google Books note type.",
        _NO_INPUT,
    ),
    Report(
        "instance_ext",
        derived.instance_ext,
        "instance_id string, instance_hrid string, cataloged_date date, title string, index_title string,"
        " type_id string, type_name string, mode_of_issuance_id string, mode_of_issuance_name string,"
        " previously_held boolean, instance_source string, discovery_suppress boolean, staff_suppress boolean,"
        " status_id string, status_name string, status_updated_date timestamp, record_source string,"
        " record_created_date timestamp, updated_by_user_id string, updated_date timestamp_ntz,"
        " match_key string, is_bound_with boolean",
        "Extended instances",
        "Instances with document metadata and the names behind their ids.",
        _NO_INPUT,
    ),
    Report(
        "item_circulation_notes",
        derived.item_circulation_notes,
        "item_id string, note_id string, note string, note_type string, staff_only boolean, ordinality bigint",
        "Item circulation notes",
        "Lists the circulation notes of all items in document order.",
        _NO_INPUT,
    ),
    Report(
        "item_ext",
        derived.item_ext,
        ", ".join(
            f"{name} {dict(discovery_suppress='boolean', created_date='timestamp_ntz').get(name, 'string')}"
            for name in derived.ITEM_EXT
        ),
        "Extended items",
        "Items with the fields of their documents and the names behind their ids.",
        _NO_INPUT,
    ),
    Report(
        "perm_rsrv_curr_circ_stats",
        courses.perm_rsrv_curr_circ_stats,
        "course_department string, course_name string, course_number string," + _TERM_TAIL,
        "Circulation counts of current permanent reserve items",
        "Counts checkouts and renewals of the items now on permanent reserve.",
        _NO_INPUT,
    ),
    Report(
        "search_notes",
        notes.search_notes,
        "item_uuid string, item_barcode string, instance_title_publisher_date string,"
        " holdings_location_call_number string, item_notes string",
        "Instances by item note",
        "Lists the items whose notes match a search text, with title, holdings and the matching notes.",
        "Enter a search text for the item note; without one the list is empty.",
        (_text("note_string", "Item Note Contains", required=False),),
    ),
    Report(
        "zero_use_items",
        circulation.zero_use_items,
        "item_id string, title string",
        "Items without use",
        "Lists the current items of a location that were not checked in during a period.",
        "Enter the dates to look between.",
        _PERIOD,
        listed=False,
    ),
]

REPORTS = {report.name: report for report in _ALL}


def run(tables: Tables, name: str, /, *, collation: str | None = None, **arguments: object) -> DataFrame:
    """Run a report by name and return its rows in the declared types.

    Parameters are those of the report's form; further keywords of the report's function
    (site constants such as a note type or a catalogue address) are accepted as well.  A text
    parameter that is not required is NULL when left out, dates fall back to their defaults; a date that is
    given as None is NULL and matches nothing.  With ``collation``, one of Spark's such as ``UNICODE`` or ``en``, sorted
    reports have their texts in that order instead of that of their bytes.  Nothing runs until the result is read; ``release`` lets go of
    what was kept for it.
    """
    report = REPORTS[name]
    given = dict(arguments)
    for parameter in report.parameters:
        value = given.get(parameter.name)
        if parameter.required and value is None:
            raise ValueError(f"{name}: {parameter.name} is required")
        if parameter.type == "text":
            given.setdefault(parameter.name, None)
        elif isinstance(value, str):
            given[parameter.name] = dt.date.fromisoformat(value)
    with keeping() as frames, collated(collation):
        result = conform(report.function(tables, **given), report.schema)
    result._kept = frames
    return result


def register_views(tables: Tables) -> list[str]:
    """Temporary views, by name, of the reports that need no parameter, for use in SQL."""
    names = [r.name for r in _ALL if not any(p.required or p.type == "text" for p in r.parameters)]
    for name in names:
        run(tables, name).createOrReplaceTempView(name)
    return names


def reports_catalog(spark: SparkSession) -> DataFrame:
    """The forms of all listed reports, one row per report."""
    rows = [
        (
            r.name,
            r.display_name,
            r.description,
            r.instructions,
            [(p.name, p.display_name, p.type, p.required) for p in r.parameters],
        )
        for r in _ALL
        if r.listed
    ]
    return spark.createDataFrame(
        rows,
        "name string, display_name string, description string, instructions string,"
        " parameters array<struct<name: string, display_name: string, type: string, required: boolean>>",
    )
