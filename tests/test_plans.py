"""What the reports' plans must look like to hold at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from biblioscope import Tables, release, run
from biblioscope.operators import history, joins, spans
from fixtures.dialects import Spark
from fixtures.relations import RELATIONS
from fixtures.warehouse import land, warehouse

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return land(warehouse(spark, SF_DIR), str(tmp_path_factory.mktemp("landed") / "warehouse"), files=2)


@pytest.fixture
def settings(spark):
    changed = {}

    def change(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


REPORTS = {
    "circ_stats_course_reserves": {"circ_stat_course_name": "supplier"},
    "class_list": {"note_string": "src"},
    "count_circulation_history": {"barcode_to_check": "B12"},
    "count_internal_use": {"barcode_to_check": "B12"},
    "course_term_circ_stats": {"term_name": "asia"},
    "display_inventory_curriculum_collection": {"i_call_number_prefix": "Curr"},
    "duplicate_oclc_numbers": {},
    "googlebooknotes": {"note_type": "1"},
    "instance_ext": {},
    "item_circulation_notes": {},
    "item_ext": {},
    "perm_rsrv_curr_circ_stats": {"term_name": "africa"},
    "search_notes": {"note_string": "src"},
    "zero_use_items": {"location_id": "19"},
}


@pytest.mark.parametrize("name", REPORTS)
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_no_report_forms_pairs_or_leaves_the_jvm(name, broadcast, tables, settings):
    tables.spark.catalog.clearCache()  # kept sets are planned when they are kept
    settings(autoBroadcastJoinThreshold=broadcast)
    text = plan(run(tables, name, **REPORTS[name]))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "CollectLimit"):
        assert operator not in text
    if broadcast == "-1":
        assert "BroadcastHashJoin" not in text and "BroadcastExchange" not in text
        assert "jsonb" not in exchanged(run(tables, name, **REPORTS[name]))


def exchanged(frame):
    """All columns that some exchange of the plan, kept sets included, writes."""
    seen, found = set(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.inputPlan()
        if node.nodeName().startswith("InMemoryTableScan"):
            cached = node.relation().cachedPlan()
            if cached.hashCode() not in seen:
                seen.add(cached.hashCode())
                walk(cached)
        if node.nodeName() == "Exchange":
            found.append(node.output().mkString(","))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return ",".join(found)


@pytest.mark.parametrize("name", REPORTS)
def test_building_a_report_runs_nothing(name, spark, tables):
    run(tables, name, **REPORTS[name])  # relations are known from here on
    spark.sparkContext.setJobGroup(f"build-{name}", "build")
    run(tables, name, **REPORTS[name])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}") == []


def test_pending_reports_survive_each_others_release(tables):
    one, two = (run(tables, "course_term_circ_stats", term_name="asia") for _ in range(2))
    release(one)
    expected = sorted(map(repr, two.collect()))
    release(two)
    assert sorted(map(repr, one.collect())) == expected != []


def test_item_table_broadcasts_its_ten_code_tables(tables):
    text = plan(run(tables, "item_ext"))
    names = [n for n in re.findall(r"BroadcastHashJoin \[(\w+)#", text) if n.endswith("_id")]
    assert len(names) == 10


def test_unasked_names_and_document_fields_are_not_read(tables):
    from biblioscope.plans.derived import item_ext

    text = plan(item_ext(tables, ["item_id", "holdings_record_id"]))
    assert "Join" not in text and "from_json" not in text and "jsonb" not in text


def test_zero_use_is_an_anti_join(tables):
    assert "LeftAnti" in plan(run(tables, "zero_use_items", location_id="19"))


@pytest.mark.parametrize("name", ["course_term_circ_stats", "perm_rsrv_curr_circ_stats"])
def test_reserves_of_other_terms_are_dropped_before_they_are_parsed(name, tables, settings):
    tables.spark.catalog.clearCache()
    settings(autoBroadcastJoinThreshold="-1", maxPlanStringLength="10000000")
    text = plan(run(tables, name, **REPORTS[name]))
    parsed = re.search(r"from_json[^\n]*copiedItem.*?(getbit|FileScan)", text, re.S)
    assert parsed.group(1) == "getbit" and "Exchange" not in parsed.group()


def test_loans_are_bounded_at_the_scan(tables):
    text = plan(run(tables, "course_term_circ_stats", term_name="asia"))
    scan = re.search(r"FileScan parquet \[id#\d+,creation_date.*", text).group()
    assert re.search(r"creation_date#\d+ >= .*subquery", scan.split("DataFilters")[1])


def test_term_without_spans_gives_no_row(tables):
    assert run(tables, "course_term_circ_stats", term_name="no such term").count() == 0


def test_date_range_reaches_the_scan(tables):
    frame = run(tables, "circ_stats_course_reserves", circ_stat_course_name="x", start_date="1999-01-01")
    scan = re.search(r"FileScan parquet \[loan_id.*", plan(frame)).group()
    assert "loan_date" in scan.split("DataFilters")[1]


def test_latest_version_is_cut_before_the_shuffle(spark):
    frame = spark.createDataFrame([("a", None, 1)], "id string, __start timestamp_ntz, __id int")
    assert "WindowGroupLimit" in plan(history.latest_per_key(frame, ["id"])).split("Exchange")[1]


def test_events_are_reduced_before_their_shuffle(spark):
    events = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "k string, d date")
    ranges = events.select("k", F.col("d").alias("lo"), F.col("d").alias("hi"))
    text = plan(spans.count_in_spans(events, ranges, on="k", by=[], day="d", start="lo", end="hi", count="n"))
    assert re.search(r"Exchange hashpartitioning\(k#\d+, day#\d+[^\n]*\n[^\n]*partial_sum", text)


def test_spans_are_kept_and_meet_events_without_a_join(spark):
    events = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "k string, d date")
    ranges = spark.createDataFrame([("a", dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "k string, lo date, hi date")
    found = spans.count_in_spans(events, ranges, on="k", by=[], day="d", start="lo", end="hi", count="n")
    operators = re.findall(r"\b\w*Join|InMemoryTableScan", re.sub(r"AdaptiveSparkPlan.*", "", plan(found)))
    assert set(operators) == {"InMemoryTableScan"}
    assert [tuple(r) for r in found.collect()] == [("a", 1)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_is_split_after_a_join_on_the_same_key(spark, settings, how):
    """A third of the rows under one key, joined twice by that key: both joins split it."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__forceOptimizeSkewedJoin="false",
        adaptive__coalescePartitions__enabled="false",
    )
    count = 60_000
    many = spark.range(count).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    keys = many.select("k").distinct()
    once = joins.spread_join(many, keys.withColumn("a", F.lit(1)), "k", how)
    twice = joins.spread_join(once.repartition(4, "k"), keys.withColumn("b", F.lit(2)), "k", how)
    result = twice.groupBy("a", "b").agg(F.count("v").alias("n"))
    assert [tuple(r) for r in result.collect()] == [(1, 2, count)]
    assert plan(result).split("Initial Plan")[0].count("skew=true") == 2


def test_catalog_and_dictionary_tables_give_the_same_report(spark, tables):
    names = ["check_in__t", "item__t"]
    for name in names:
        tables[name].createOrReplaceTempView(f"v_{name}")
    by_catalog = Tables.catalog(spark, {name: f"v_{name}" for name in names})
    one, two = (
        run(t, "count_circulation_history", barcode_to_check="B12") for t in (tables, by_catalog)
    )
    assert sorted(one.collect()) == sorted(two.collect()) != []


def test_passes_over_the_derived_history_share_its_shuffle(spark, settings):
    """Where both the listings and the spans of current reserves are read, the window behind the relation is shuffled once."""
    settings(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    reserves = warehouse(spark, SF_DIR)["coursereserves_reserves"]
    spans = history.version_span(reserves, "id").select("id", "first_start", "last_end")
    listed = reserves.select("id", "courselistingid", "__id", "__start", "jsonb")
    plan = listed.join(spans, "id")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange \[l_orderkey#\d+L, l_partkey#\d+L, l_suppkey", plan)


def test_the_derived_history_has_the_rows_of_its_text(spark):
    ours = warehouse(spark, SF_DIR)["reserve_versions"]
    theirs = spark.sql(RELATIONS["reserve_versions"](Spark()), lineitem=spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    assert ours.dtypes == theirs.dtypes
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
