"""Semantics of the reports on small inline relations; expected rows worked out by hand."""

import datetime as dt
import json

import pytest

from biblioscope import Tables, run

OPEN = dt.datetime(9999, 12, 31)


def at(day, hour=12):
    return dt.datetime.fromisoformat(day) + dt.timedelta(hours=hour)


def rows(frame):
    return [tuple(row) for row in frame.collect()]


SCHEMAS = {
    "coursereserves_terms": "id string, jsonb string",
    "coursereserves_departments": "id string, jsonb string",
    "coursereserves_courselistings__": "id string, __id string, jsonb string, __start timestamp_ntz, __end timestamp_ntz",
    "coursereserves_courses__": "id string, __id string, jsonb string, __start timestamp_ntz, __end timestamp_ntz",
    "coursereserves_reserves__": "id string, __id string, courselistingid string, jsonb string,"
    " __start timestamp_ntz, __end timestamp_ntz",
    "loan__": "id string, creation_date timestamp_ntz, jsonb string",
    "item": "id string, creation_date timestamp_ntz, holdingsrecordid string, effectivelocationid string,"
    " materialtypeid string, permanentloantypeid string, temporaryloantypeid string, permanentlocationid string,"
    " temporarylocationid string, jsonb string",
    "item__t": "id string, hrid string, barcode string, enumeration string, volume string, copy_number string,"
    " holdings_record_id string, effective_location_id string",
    "item__t__": "id string, barcode string, holdings_record_id string, __current boolean",
    "holdings_record__t": "id string, hrid string, call_number string, call_number_prefix string, instance_id string",
    "holdings_record__t__": "id string, instance_id string, permanent_location_id string",
    "instance": "id string, jsonb string",
    "instance__t": "id string, hrid string, title string, index_title string, source string, cataloged_date string,"
    " instance_type_id string, mode_of_issuance_id string, previously_held boolean, discovery_suppress boolean,"
    " staff_suppress boolean, status_id string, status_updated_date timestamp_ntz",
    "instance__t__": "id string, title string",
    "check_in__t": "id string, item_id string, occurred_date_time timestamp_ntz, item_status_prior_to_check_in string",
    "check_in__t__": "id string, item_id string, occurred_date_time timestamp_ntz, item_status_prior_to_check_in string",
    "loans_items": "loan_id string, item_id string, loan_date timestamp_ntz",
    "coursereserves_courses__t__": "name string, course_listing_id string",
    "coursereserves_reserves__t__": "course_listing_id string, item_id string",
    "item_notes": "item_id string, note string",
    "instance_contributors": "instance_id string, contributor_name string, contributor_is_primary boolean",
    "instance_publication": "instance_id string, publisher string, date_of_publication string",
    "locations_libraries": "location_id string, location_code string",
    "holdings_ext": "holdings_id string, instance_id string, permanent_location_name string, call_number string",
    "items_holdings_instances": "item_id string, barcode string, title string, holdings_id string, instance_id string",
}
CODES = """location__t material_type__t loan_type__t service_point__t item_damaged_status__t call_number_type__t
    item_note_type__t instance_type__t mode_of_issuance__t instance_status__t""".split()


@pytest.fixture
def world(spark):
    """Tables from lists of dicts; absent columns are NULL, absent relations empty, documents JSON."""

    def build(**relations):
        schemas = {**SCHEMAS, **{c: "id string, name string" for c in CODES}}
        assert relations.keys() <= schemas.keys()

        def find(name):
            if name not in schemas:
                return None
            fields = [part.split()[0] for part in schemas[name].split(",")]
            given = relations.get(name, [])
            assert all(set(r) <= set(fields) for r in given), name
            records = [tuple(json.dumps(r[f]) if f == "jsonb" and f in r else r.get(f) for f in fields) for r in given]
            return spark.createDataFrame(records, schemas[name])

        return Tables(spark, find)

    return build


# --- term reports -----------------------------------------------------------------------------


def listing(id, term, start="2024-01-10", end=None, version="1", **document):
    return {
        "id": id, "__id": version, "jsonb": {"termId": term, **document},
        "__start": at(start), "__end": at(end) if end else OPEN,
    }


def course(id, listing_id, start="2024-01-01", version="1", **document):
    return {
        "id": id, "__id": version, "jsonb": {"courseListingId": listing_id, "name": f"Course {id}", **document},
        "__start": at(start), "__end": OPEN,
    }


def reserve(id, listing_id, item="i1", start="2024-01-05", end=None, version="1", **copied):
    return {
        "id": id, "__id": version, "courselistingid": listing_id,
        "jsonb": {"itemId": item, "copiedItem": {"barcode": "B1", "title": "T" * 90, "callNumber": "CN", **copied}},
        "__start": at(start), "__end": end if end is None or isinstance(end, dt.datetime) else at(end),
    }


def loan(day, item="i1", action="checkedout", id="l", hour=12):
    return {"id": id, "creation_date": at(day, hour), "jsonb": {"itemId": item, "action": action}}


TERMS = [{"id": "t1", "jsonb": {"name": " Winter 2024"}}, {"id": "t2", "jsonb": {"name": "Permanent"}}]


def term(world, name="winter 2024 ", report="course_term_circ_stats", **relations):
    relations.setdefault("coursereserves_terms", TERMS)
    relations.setdefault("coursereserves_courselistings__", [listing("L", "t1")])
    relations.setdefault("coursereserves_courses__", [course("c1", "L")])
    relations.setdefault("coursereserves_reserves__", [reserve("r1", "L", end=OPEN)])
    arguments = {"term_name": name} if report == "course_term_circ_stats" else {}
    return run(world(**relations), report, **arguments).collect()


def test_term_report_row(world):
    [row] = term(
        world,
        coursereserves_departments=[{"id": "d", "jsonb": {"name": "History"}}],
        coursereserves_courselistings__=[listing("L", "t1", instructorObjects=[{"name": "Ada"}, {"name": "Bob"}])],
        coursereserves_courses__=[course("c1", "L", courseNumber="H1", departmentId="d")],
        loan__=[loan("2024-02-01")],
        item=[{"id": "i1", "jsonb": {"effectiveCallNumberComponents": {"prefix": "P", "callNumber": "Q"}, "copyNumber": "2"}}],
    )
    assert tuple(row) == (
        " Winter 2024", "History", "H1", "Course c1", "Ada", 1, "T" * 80, "P Q c.2", "B1",
        dt.date(2024, 1, 10), dt.date(9999, 12, 30), "L", "c1", "i1",
    )


def test_term_report_fills_only_some_nulls(world):
    [row] = term(world, coursereserves_reserves__=[reserve("r1", "L", end=OPEN, barcode=None, title=None, callNumber=None)])
    assert (row.course_department, row.course_number, row.primary_instructor, row.checkout_count) == ("", "", "", 0)
    assert (row.item_title, row.call_number, row.item_barcode) == (None, None, None)


def test_term_is_found_by_id_and_several_terms_may_match(world):
    assert len(term(world, name=" T1")) == 1
    both = [{"id": "t1", "jsonb": {"name": "x"}}, {"id": "x", "jsonb": {"name": "y"}}]
    listings = [listing("L", "t1"), listing("M", "x")]
    found = term(
        world, name="X", coursereserves_terms=both, coursereserves_courselistings__=listings,
        coursereserves_courses__=[course("c1", "L"), course("c2", "M")],
        coursereserves_reserves__=[reserve("r1", "L", end=OPEN), reserve("r2", "M", end=OPEN)],
    )
    assert sorted(r.course_term for r in found) == ["x", "y"]
    assert term(world, name="no such term") == []


def test_listing_moved_to_another_term_counts_by_its_last_version_here(world):
    versions = [
        listing("L", "t1", "2023-01-01", "2023-06-01", "1", instructorObjects=[{"name": "first"}]),
        listing("L", "t1", "2023-06-01", "2024-03-01", "2", instructorObjects=[{"name": "second"}]),
        listing("L", "t2", "2024-03-01", None, "3"),
    ]
    [row] = term(world, coursereserves_courselistings__=versions)
    assert (row.primary_instructor, row.course_item_end) == ("second", dt.date(2024, 3, 1))


def test_latest_course_version_wins_and_course_without_listing_is_absent(world):
    versions = [course("c1", "L", name="Old"), course("c1", "L", "2024-02-01", "2", name="New"), course("c2", None)]
    assert [r.course_name for r in term(world, coursereserves_courses__=versions)] == ["New"]


def test_cross_listed_courses_repeat_the_reserve(world):
    found = term(world, coursereserves_courses__=[course("c1", "L"), course("c2", "L")], loan__=[loan("2024-02-01")])
    assert [(r.course_id, r.checkout_count) for r in found] == [("c1", 1), ("c2", 1)]


def test_reserve_span_runs_over_all_versions_of_the_reserve(world):
    versions = [
        reserve("r1", "M", start="2024-01-20", end="2024-02-01"),
        reserve("r1", "L", start="2024-02-01", end="2024-03-01", version="2"),
        reserve("r1", "M", start="2024-03-01", end="2024-04-01", version="3"),
    ]
    [row] = term(world, coursereserves_reserves__=versions)
    assert (row.course_item_start, row.course_item_end) == (dt.date(2024, 1, 20), dt.date(2024, 4, 1))


def test_reserve_version_without_an_end_has_no_end_and_counts_no_loan(world):
    [row] = term(world, coursereserves_reserves__=[reserve("r1", "L")], loan__=[loan("2024-02-01")])
    assert (row.course_item_end, row.checkout_count) == (None, 0)


def test_every_loan_version_with_a_checkout_action_counts(world):
    actions = ["checkedOut", "renewed", "CHECKEDOUTTHROUGHOVERRIDE", "renewedThroughOverride", "checkedin", "xrenewed", "renewed\n"]
    loans = [loan("2024-02-01", action=a) for a in actions] + [loan("2024-02-01", item="other")]
    assert term(world, loan__=loans)[0].checkout_count == 4


def test_loans_are_placed_by_their_local_day(world):
    reserves = [reserve("r1", "L", start="2024-07-01", end="2024-07-02")]
    loans = [loan("2024-07-01", hour=6), loan("2024-07-01", hour=7), loan("2024-07-03", hour=6), loan("2024-07-03", hour=7)]
    assert term(world, coursereserves_reserves__=reserves, loan__=loans)[0].checkout_count == 2


def test_item_reserved_twice_on_a_listing_inflates_the_count(world):
    twice = [reserve("r1", "L", end=OPEN), reserve("r2", "L", end=OPEN)]
    assert [r.checkout_count for r in term(world, coursereserves_reserves__=twice, loan__=[loan("2024-02-01")])] == [2, 2]


def test_differing_barcodes_multiply_the_rows(world):
    twice = [reserve("r1", "L", end=OPEN), reserve("r2", "L", end=OPEN, barcode="B2")]
    found = term(world, coursereserves_reserves__=twice, loan__=[loan("2024-02-01")])
    assert sorted((r.item_barcode, r.checkout_count) for r in found) == [("B1", 1), ("B1", 1), ("B2", 1), ("B2", 1)]


def test_item_id_of_a_reserve_is_normalised_for_the_shelf_but_not_for_loans(world):
    [row] = term(
        world, coursereserves_reserves__=[reserve("r1", "L", item="ABC", end=OPEN)],
        item=[{"id": "abc", "jsonb": {"effectiveCallNumberComponents": {"callNumber": "Q"}}}],
        loan__=[loan("2024-02-01", item="abc")],
    )
    assert (row.call_number, row.checkout_count) == ("Q", 0)


def test_reserves_on_several_listings_keep_their_latest_version(world):
    rows = term(
        world,
        coursereserves_courselistings__=[listing(f"L{i}", "t1") for i in range(4)],
        coursereserves_courses__=[course(f"c{i}", f"L{i}") for i in range(4)],
        coursereserves_reserves__=[reserve(f"r{i % 3}", f"L{i % 5}", end=OPEN, version=str(i)) for i in range(20)],
        loan__=[loan("2024-02-01")],
    )
    assert len(rows) == 12


def test_permanent_report_looks_at_current_versions_only(world):
    relations = dict(
        coursereserves_courselistings__=[listing("L", "t2"), listing("M", "t2", "2023-01-01", "2024-01-01")],
        coursereserves_courses__=[course("c1", "L", courseNumber="N"), course("c2", "M")],
        coursereserves_reserves__=[
            reserve("r1", "L", start="2024-01-05", end="2024-02-01"),
            reserve("r1", "L", start="2024-02-01", end=OPEN, version="2"),
            reserve("r2", "L", end="2024-03-01"),
        ],
        loan__=[loan("2024-01-20"), loan("2024-02-20")],
    )
    [row] = term(world, report="perm_rsrv_curr_circ_stats", **relations)
    assert row[:5] == ("", "Course c1", "N", "", 1) and row.course_item_start == dt.date(2024, 2, 1)
    assert "course_term" not in row
    history = term(world, name="permanent", **relations)
    assert sorted((r.course_item_start, r.course_listing_id) for r in history) == [
        (dt.date(2024, 1, 10), "L"), (dt.date(2024, 1, 10), "L"),
    ]


def test_single_version_histories_give_both_reports_the_same_rows(world):
    relations = dict(
        coursereserves_courselistings__=[listing("L", "t2")], loan__=[loan("2024-01-20")],
        coursereserves_reserves__=[reserve("r1", "L", end=OPEN), reserve("r2", "L", item="i2", end=OPEN)],
    )
    current = term(world, report="perm_rsrv_curr_circ_stats", **relations)
    history = term(world, name="permanent", **relations)
    shown = current[0].__fields__
    assert sorted(map(tuple, current)) == sorted(tuple(r[c] for c in shown) for r in history)


def test_term_rows_are_sorted_with_nulls_last(world):
    courses = [course("c1", "L", courseNumber="B"), course("c2", "L", courseNumber="A", name=None), course("c3", "L", courseNumber="A")]
    assert [r.course_id for r in term(world, coursereserves_courses__=courses)] == ["c3", "c2", "c1"]


# --- reserve circulation by course name ---------------------------------------------------------


def test_course_circulation(world):
    tables = world(
        coursereserves_courses__t__=[{"name": "Art HISTORY", "course_listing_id": "L"}, {"name": "History 2", "course_listing_id": "L"}],
        coursereserves_reserves__t__=[{"course_listing_id": "L", "item_id": i} for i in ("i1", "i1", "i2", "i3", "i4")],
        loans_items=[{"loan_id": "l", "item_id": i, "loan_date": at(d, h)} for i, d, h in [
            ("i1", "2024-01-01", 0), ("i1", "2024-01-31", 23), ("i1", "2024-02-01", 0), ("i2", "2024-01-05", 1), ("i4", "2024-01-05", 1)]],
        item=[{"id": "i1", "holdingsrecordid": "h"}, {"id": "i2", "holdingsrecordid": None}],
        item__t=[{"id": "i1", "barcode": "B1"}, {"id": "i2", "barcode": "B2"}],
        holdings_ext=[{"holdings_id": "h", "instance_id": "n"}],
        instance__t=[{"id": "n", "title": "Title"}],
    )
    frame = run(tables, "circ_stats_course_reserves", circ_stat_course_name="history", start_date="2024-01-01", end_date="2024-01-31")
    assert rows(frame) == [("B1", "Title", 2), ("B2", None, 1), (None, None, 1)]
    everything = run(tables, "circ_stats_course_reserves", circ_stat_course_name="^art")
    assert rows(everything)[0] == ("B1", "Title", 3)


# --- check-ins --------------------------------------------------------------------------------


def check_in(id, item="i1", day="2024-01-02", status="Checked out", hour=0, second=0):
    return {
        "id": id, "item_id": item, "item_status_prior_to_check_in": status,
        "occurred_date_time": at(day, hour) + dt.timedelta(seconds=second),
    }


def test_circulation_history_ends_at_midnight_of_the_end_day(world):
    tables = world(
        item__t=[{"id": "i1", "barcode": "B1"}, {"id": "i2", "barcode": "B2"}],
        check_in__t=[check_in("1", day="2024-01-01"), check_in("2"), check_in("3", second=1), check_in("4", "i2"), check_in("5", status="Available")],
    )
    frame = run(tables, "count_circulation_history", barcode_to_check="B1", start_date="2024-01-01", end_date="2024-01-02")
    assert sorted(rows(frame)) == [("1", dt.date(2024, 1, 1)), ("2", dt.date(2024, 1, 2))]
    assert run(tables, "count_circulation_history", barcode_to_check="B1").count() == 3


def test_internal_use_counts_every_version_of_a_check_in_and_only_current_items(world):
    items = [("i1", "B1", True), ("i1", "OLD", False), ("i2", "B2", True)]
    tables = world(
        item__t__=[{"id": i, "barcode": b, "__current": c} for i, b, c in items],
        check_in__t__=[check_in("1", status="Available"), check_in("1", status="Available"), check_in("2")],
    )
    counts = {b: rows(run(tables, "count_internal_use", barcode_to_check=b)) for b in ("B1", "OLD", "B2", "none")}
    assert counts == {"B1": [(2,)], "OLD": [(0,)], "B2": [(0,)], "none": [(0,)]}


def test_zero_use_items(world):
    tables = world(
        item__t__=[{"id": i, "holdings_record_id": h, "__current": c} for i, h, c in [
            ("used", "h1", True), ("unused", "h1", True), ("later", "h1", True), ("old", "h1", False), ("elsewhere", "h2", True)]],
        holdings_record__t__=[{"id": "h1", "instance_id": "n", "permanent_location_id": "here"}, {"id": "h2", "instance_id": "n", "permanent_location_id": "there"}],
        instance__t__=[{"id": "n", "title": "T"}],
        check_in__t__=[check_in("1", "used"), check_in("2", "later", "2025-01-01"), check_in("3", None)],
    )
    frame = run(tables, "zero_use_items", start_date="2024-01-01", end_date="2024-12-31", location_id="here")
    assert sorted(rows(frame)) == [("later", "T"), ("unused", "T")]


# --- inventory --------------------------------------------------------------------------------


def test_inventory_by_prefix(world):
    tables = world(
        item__t=[{"id": "i1", "barcode": "B1", "holdings_record_id": "h1", "effective_location_id": "l"},
                 {"id": "i2", "holdings_record_id": "h2"}, {"id": "i3", "holdings_record_id": "h3"}],
        holdings_record__t=[{"id": "h1", "call_number_prefix": "Ref", "call_number": "Q", "instance_id": "n1"},
                            {"id": "h2", "call_number_prefix": "Ref", "instance_id": "n2"},
                            {"id": "h3", "call_number_prefix": "ref", "instance_id": "n1"}],
        location__t=[{"id": "l", "name": "Stacks"}],
        instance__t=[{"id": "n1", "hrid": "b123456789", "index_title": "t"}, {"id": "n2", "hrid": "in1"}],
        instance_contributors=[{"instance_id": "n1", "contributor_name": n, "contributor_is_primary": p} for n, p in [
            ("Ann", True), ("Ann", True), ("Bob", False), ("Cat", None)]],
    )
    frame = run(tables, "display_inventory_curriculum_collection", i_call_number_prefix="Ref", record_url="u/")
    assert rows(frame) == [("Stacks", "t", "Ann", "Curr Q", None, None, "u/b1234567", "B1", "i1", "h1")]


def test_duplicate_identifiers(world):
    def instance(id, *values, codes=("x",), **document):
        identifiers = [{"identifierTypeId": "oclc", "value": v} for v in values] + [{"identifierTypeId": "isbn", "value": "9"}]
        coded = {} if codes is None else {"statisticalCodeIds": list(codes)}
        return {"id": id, "jsonb": {"identifiers": identifiers, **coded, **document}}

    tables = world(instance=[
        instance("1", "A", "A"), instance("2", "A", "B", staffSuppress=False), instance("3", "B", "C"),
        instance("4", "B", staffSuppress="false"), instance("5", "C", codes=None), instance("6", "C", codes=("x", "KNOWN")),
        instance("7", "C", staffSuppress=True), instance("8", codes=()), {"id": "9", "jsonb": {"statisticalCodeIds": []}},
    ])
    frame = run(tables, "duplicate_oclc_numbers", identifier_type="oclc", known_duplicate='"known"')
    assert rows(frame) == [(3, "oclc", "B"), (2, "oclc", "A")]


# --- notes ------------------------------------------------------------------------------------


def test_class_list(world):
    document = {"effectiveCallNumberComponents": {"prefix": "P", "callNumber": "Q"}, "copyNumber": "1"}
    tables = world(
        item_notes=[{"item_id": "i1", "note": "Used in ART 1"}, {"item_id": "i1", "note": "Used in ART 1"},
                    {"item_id": "i1", "note": "gift"}, {"item_id": "gone", "note": "art"}, {"item_id": "i1", "note": None}],
        item=[{"id": "i1", "holdingsrecordid": "h", "effectivelocationid": "l", "jsonb": document}],
        item__t=[{"id": "i1", "barcode": "B1"}],
        location__t=[{"id": "l", "name": "Stacks"}],
        locations_libraries=[{"location_id": "l", "location_code": "st"}],
        holdings_ext=[{"holdings_id": "h", "instance_id": "n"}],
    )
    assert rows(run(tables, "class_list", note_string="art")) == [("B1", "st", "Stacks", "P Q Q  1", None, "Used in ART 1")]
    assert rows(run(tables, "class_list")) == []


def test_search_notes_repeats_notes_per_contributor_and_splits_by_publication(world):
    tables = world(
        items_holdings_instances=[{"item_id": "i1", "barcode": "B1", "title": "T", "holdings_id": "h", "instance_id": "n"},
                                  {"item_id": "i2", "title": "U"}],
        item_notes=[{"item_id": "i1", "note": n} for n in ("src b", "SRC a", "src b", "other", None)] + [{"item_id": "i2", "note": "src"}],
        instance_contributors=[{"instance_id": "n", "contributor_name": c} for c in "xy"],
        instance_publication=[{"instance_id": "n", "publisher": "P", "date_of_publication": "1999"}, {"instance_id": "n"}],
        holdings_ext=[{"holdings_id": "h", "permanent_location_name": "Stacks"}],
    )
    text = "SRC a, SRC a, src b, src b, src b, src b"
    assert sorted(rows(run(tables, "search_notes", note_string="src")), key=str) == [
        ("i1", "B1", "T, , ", "Stacks, ", text), ("i1", "B1", "T, P, 1999", "Stacks, ", text), ("i2", None, "U, , ", ", ", "src"),
    ]
    assert rows(run(tables, "search_notes", note_string=None)) == []


def test_notes_of_type(world):
    kind = "7a46e1ca-d2eb-49a3-9935-59bed639e6f1"
    notes = [{"note": "first", "itemNoteTypeId": "other"}, {"note": "second", "itemNoteTypeId": kind.upper(), "staffOnly": True}]
    tables = world(
        item=[{"id": "i1", "holdingsrecordid": "h", "effectivelocationid": "l", "materialtypeid": "m",
               "jsonb": {"hrid": "it1", "formerIds": ["a", "b"], "notes": notes}}, {"id": "i2", "jsonb": {"notes": []}}, {"id": "i3", "jsonb": {}}],
        item_note_type__t=[{"id": kind, "name": "Books"}, {"id": "other", "name": "Other"}],
        holdings_record__t=[{"id": "h", "hrid": "ho1", "call_number": "Q", "instance_id": "n"}],
        instance__t=[{"id": "n", "title": "T", "discovery_suppress": False}],
        location__t=[{"id": "l", "name": "Stacks"}], material_type__t=[{"id": "m", "name": "book"}],
    )
    assert rows(run(tables, "googlebooknotes")) == [
        ("false", "it1", "ho1", "Stacks", None, '["a", "b"]', "Q", None, "book", "T", "Books", "second", "true", 2)
    ]


def test_circulation_notes(world):
    notes = [{"id": "ABC", "note": "n1", "noteType": "Check in", "staffOnly": True}, {"note": "n2"}]
    tables = world(item=[{"id": "i1", "jsonb": {"circulationNotes": notes}}, {"id": "i2", "jsonb": {"circulationNotes": []}}])
    assert rows(run(tables, "item_circulation_notes")) == [
        ("i1", "abc", "n1", "Check in", True, 1), ("i1", None, "n2", None, None, 2)
    ]


# --- derived tables ---------------------------------------------------------------------------


def test_instance_ext_defaults_and_missing_document(world):
    tables = world(
        instance__t=[{"id": "n", "source": "MARC", "cataloged_date": "2020-02-03", "staff_suppress": True, "status_id": "s"}],
        instance_status__t=[{"id": "s", "name": "Cataloged"}],
    )
    [row] = run(tables, "instance_ext").collect()
    assert (row.previously_held, row.discovery_suppress, row.staff_suppress, row.is_bound_with) == (False, False, True, False)
    assert (row.instance_source, row.record_source, row.status_name) == ("MARC", "MARC", "Cataloged")
    assert (row.cataloged_date, row.updated_date, row.match_key) == (dt.date(2020, 2, 3), None, None)


def test_item_ext_keeps_items_without_flat_row_and_has_no_default_suppression(world):
    tables = world(
        item=[{"id": "i1", "creation_date": at("2020-01-01"), "permanentlocationid": "l", "effectivelocationid": "l",
               "jsonb": {"barcode": "X", "itemLevelCallNumber": "Q", "itemIdentifier": "id", "itemDamagedStatusId": "ABC"}}],
        location__t=[{"id": "l", "name": "Stacks"}], item_damaged_status__t=[{"id": "abc", "name": "Damaged"}],
    )
    [row] = run(tables, "item_ext").collect()
    assert len(row) == 43 and (row.barcode, row.call_number, row.identifier) == (None, "Q", "id")
    assert (row.permanent_location_name, row.effective_location_name, row.temporary_location_name) == ("Stacks", "Stacks", None)
    assert (row.damaged_status_name, row.discovery_suppress, row.created_date) == ("Damaged", None, at("2020-01-01"))


def test_stored_derived_table_is_read_in_place_of_its_parts(spark, world):
    parts = world(item=[{"id": "i1", "jsonb": {}}, {"id": "i2", "jsonb": {}}], item__t=[{"id": "i1", "barcode": "B"}])
    stored = run(parts, "item_ext")
    tables = Tables.of(spark, {"item_ext": stored})
    assert sorted(map(str, rows(run(tables, "item_ext")))) == sorted(map(str, rows(stored)))


def test_class_list_reads_a_stored_item_table(spark, world):
    parts = world(
        item=[{"id": "i1", "jsonb": {}}], item__t=[{"id": "i1", "barcode": "B"}], item_notes=[{"item_id": "i1", "note": "x"}]
    )
    frames = {name: parts[name] for name in ("item_notes", "holdings_ext", "instance__t", "locations_libraries")}
    tables = Tables.of(spark, {**frames, "item_ext": run(parts, "item_ext")})
    assert rows(run(tables, "class_list", note_string="x")) == rows(run(parts, "class_list", note_string="x"))
