"""The report registry: forms, argument handling and declared types."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import biblioscope.plans.catalog as catalog
from biblioscope import REPORTS, register_views, reports_catalog, run, store_derived
from fixtures.warehouse import warehouse

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return warehouse(spark, SF_DIR)


def test_catalog_lists_every_report_with_a_form(spark):
    listed = {row.name: row for row in reports_catalog(spark).collect()}
    assert listed.keys() == REPORTS.keys() - {"zero_use_items"} and len(listed) == 13
    period = listed["circ_stats_course_reserves"].parameters
    assert [(p.name, p.type, p.required) for p in period] == [
        ("circ_stat_course_name", "text", True), ("start_date", "date", False), ("end_date", "date", False),
    ]
    assert not listed["class_list"].parameters[0].required
    assert listed["item_ext"].parameters == []


def test_required_parameter_must_be_given(tables):
    with pytest.raises(ValueError, match="barcode_to_check"):
        run(tables, "count_internal_use")
    with pytest.raises(KeyError):
        run(tables, "no_such_report")
    with pytest.raises(TypeError):
        run(tables, "count_internal_use", barcode_to_check="B1", colour="red")


def test_dates_may_be_texts_and_default_when_absent(tables, monkeypatch):
    seen = {}

    def function(tables, barcode_to_check, start_date="first", end_date="last"):
        seen.update(start=start_date, end=end_date)
        return tables.spark.range(0).selectExpr("cast(id as string)", "current_date()")

    report = catalog.REPORTS["count_circulation_history"]
    monkeypatch.setitem(catalog.REPORTS, report.name, catalog.Report(**{**report.__dict__, "function": function}))
    run(tables, report.name, barcode_to_check="B", start_date="2024-02-03")
    assert seen == {"start": dt.date(2024, 2, 3), "end": "last"}


def test_a_date_that_is_null_matches_nothing(tables):
    given = {"barcode_to_check": "B12", "start_date": None}
    assert run(tables, "count_circulation_history", **given).count() == 0
    assert run(tables, "circ_stats_course_reserves", circ_stat_course_name="supplier", end_date=None).count() == 0


def test_reports_without_parameters_are_views(spark, tables):
    names = register_views(tables)
    assert {"item_ext", "instance_ext", "item_circulation_notes", "duplicate_oclc_numbers"} <= set(names)
    assert spark.sql("select count(*) from item_ext").first()[0] == run(tables, "item_ext").count()


def test_storing_again_rebuilds_from_the_base_tables(tables, tmp_path):
    stored = store_derived(tables, str(tmp_path))
    changed = stored.having({"item__t": stored["item__t"].withColumn("barcode", F.lit("new"))})
    again = store_derived(changed, str(tmp_path))
    assert {r[0] for r in run(again, "item_ext").select("barcode").collect()} <= {"new", None}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["instance_ext", "item_circulation_notes", "item_ext"]


ARGUMENTS = {
    "circ_stats_course_reserves": {"circ_stat_course_name": "supplier"},
    "count_circulation_history": {"barcode_to_check": "B12"},
    "count_internal_use": {"barcode_to_check": "B12"},
    "course_term_circ_stats": {"term_name": "asia"},
    "display_inventory_curriculum_collection": {"i_call_number_prefix": "Curr"},
}


def test_reports_read_the_stored_derived_tables(tables, tmp_path):
    stored = store_derived(tables, str(tmp_path))
    calls = [
        ("item_ext", {}), ("instance_ext", {}), ("item_circulation_notes", {}),
        ("class_list", {"note_string": "src1"}), ("circ_stats_course_reserves", {"circ_stat_course_name": "supplier"}),
    ]
    for name, arguments in calls:
        frame = run(stored, name, **arguments)
        assert any(str(tmp_path) in file for file in frame.inputFiles())
        assert Counter(map(repr, frame.collect())) == Counter(map(repr, run(tables, name, **arguments).collect()))


@pytest.mark.parametrize("name", REPORTS)
def test_report_has_its_declared_types(name, tables):
    frame = run(tables, name, **ARGUMENTS.get(name, {}))
    declared = T._parse_datatype_string(REPORTS[name].schema)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in declared]
