"""Histories in buckets and daily counts: what they spare, and that reports do not change by them."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from biblioscope import Tables, run, store_daily, store_histories, store_lookups, stored
from biblioscope.operators import history
from biblioscope.plans import courses, upkeep
from biblioscope.sources.snapshots import Snapshots
from fixtures.relations import RELATIONS
from fixtures.warehouse import land, warehouse
from tests.test_snapshots import read_by

SF_DIR = "/root/testdata/sf0.001"
TERM = {"course_term_circ_stats": {"term_name": "asia"}, "perm_rsrv_curr_circ_stats": {"term_name": "africa"}}


def rows(frame):
    return sorted(map(repr, frame.collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return land(warehouse(spark, SF_DIR), str(tmp_path_factory.mktemp("landed") / "warehouse"), files=2)


@pytest.fixture(scope="module")
def bucketed(spark, tables, tmp_path_factory):
    schema = f"h{uuid.uuid4().hex}"
    spark.sql(f"create schema {schema} location 'file://{tmp_path_factory.mktemp('buckets')}'")
    yield store_histories(tables, schema, 4)
    spark.sql(f"drop schema {schema} cascade")


@pytest.fixture
def shuffled(spark):
    """Nothing is broadcast, as where all sides are large."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_every_history_is_known_to_lie_by_its_key(tables, bucketed):
    for name in ("item__", "item__t__", "coursereserves_reserves__", "check_in__t__"):
        assert bucketed.clustered(name) == ["id"] and tables.clustered(name) == []
        assert rows(bucketed[name]) == rows(tables[name])
    assert bucketed.clustered("coursereserves_reserves") == ["id"]  # taken from its history
    assert bucketed.clustered("item") == bucketed.clustered("loan__") == bucketed.clustered("none") == []
    assert bucketed.without("item__").clustered("item__t__") == ["id"]


def test_spans_and_latest_versions_need_no_shuffle(bucketed, shuffled):
    reserves, items = bucketed["coursereserves_reserves__"], bucketed["item__"]
    frames = [
        history.version_span(reserves, "id"),
        history.with_version_span(reserves, "id"),
        history.latest_per_key(reserves, ["id"]),
        history.latest_per_key(reserves, ["id", "courselistingid"]),
        history.version_span(reserves, "id").join(history.latest_per_key(reserves, ["id"]), "id"),
        history.latest_per_key(items, ["id"]).join(history.latest_per_key(bucketed["item__t__"], ["id"]), "id"),
    ]
    for frame in frames:
        text = plan(frame)
        assert "Bucketed: true" in text and "Exchange" not in text


def test_buckets_grow_in_number_and_not_in_rows(spark, tables, tmp_path):
    names = ["coursereserves_courses__", "coursereserves_reserves__"]
    counts = []
    for most in (10**6, 500):
        schema = f"h{uuid.uuid4().hex}"
        spark.sql(f"create schema {schema} location 'file://{tmp_path / schema}'")
        found = store_histories(tables, schema, 4, names, most)
        assert all(rows(found[name]) == rows(tables[name]) and found.clustered(name) == ["id"] for name in names)
        counts.append([int(spark.sql(f"describe extended {schema}.{name}").where("col_name = 'Num Buckets'").first()["data_type"]) for name in names])
        spark.sql(f"drop schema {schema} cascade")
    versions = tables["coursereserves_reserves__"].count()
    assert counts[0] == [4, 4]
    assert counts[1] == [4 * -(-versions // 2000)] * 2 and counts[1][0] > 4


@pytest.mark.parametrize("version", ["__", ""])
def test_reserve_spans_of_the_term_report_move_by_listing_alone(bucketed, shuffled, version):
    listings = bucketed["coursereserves_courselistings__"].select(F.col("id").alias("clid"), F.lit(dt.date(1995, 1, 1)).alias("cls_start"), F.lit(dt.date(2030, 1, 1)).alias("cls_end")).distinct()
    text = plan(courses._reserve_items(bucketed, version, listings))
    assert text.count("coursereserves_reserves__[") == 1  # one pass over the history
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert moved and set(moved) == {"clid"}


@pytest.mark.parametrize("name", TERM)
def test_term_reports_are_the_same_on_both_layouts(name, tables, bucketed):
    assert rows(run(bucketed, name, **TERM[name])) == rows(run(tables, name, **TERM[name])) != []


def test_one_hot_record_in_a_bucketed_history(spark, tmp_path_factory):
    """A third of all versions belong to one reserve, on many listings."""
    versions = [(("hot" if i % 3 == 0 else f"r{i % 40}"), i, f"l{i % 5}", f"2020-01-{1 + i % 28:02d}", None if i == 297 else f"2021-01-{1 + i % 28:02d}", f'{{"itemId": "i{i % 7}"}}') for i in range(300)]
    frame = spark.createDataFrame(versions, "id string, __id long, courselistingid string, s string, e string, jsonb string")
    frame = frame.select("id", "__id", "courselistingid", F.col("s").cast("timestamp_ntz").alias("__start"), F.col("e").cast("timestamp_ntz").alias("__end"), "jsonb")
    plain = Tables.of(spark, {"coursereserves_reserves__": frame})
    schema = f"h{uuid.uuid4().hex}"
    spark.sql(f"create schema {schema} location 'file://{tmp_path_factory.mktemp('hot')}'")
    kept = store_histories(plain, schema, 3)
    listings = spark.createDataFrame([(f"l{i}", dt.date(2020, 1, 5), None if i else dt.date(2021, 1, 9)) for i in range(4)], "clid string, cls_start date, cls_end date")
    one, two = (courses._reserve_items(t, "__", listings) for t in (plain, kept))
    assert rows(one) == rows(two) != []
    spark.sql(f"drop schema {schema} cascade")


@pytest.fixture(scope="module")
def daily(tables, tmp_path_factory):
    return store_daily(tables, str(tmp_path_factory.mktemp("daily")))


REPORTS = {**TERM, "circ_stats_course_reserves": {"circ_stat_course_name": "supplier", "start_date": "1994-02-03", "end_date": "1997-05-06"}}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_daily_counts_instead_of_loans(name, tables, daily):
    frame = run(daily.without("loan__", "loans_items"), name, **REPORTS[name])
    assert rows(frame) == rows(run(tables, name, **REPORTS[name])) != []
    read = frame._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"loan_date|creation_date#\d+, jsonb", read)


def test_a_period_reaches_the_scan_of_daily_counts(daily):
    text = plan(run(daily, "circ_stats_course_reserves", circ_stat_course_name="x", start_date="1994-02-03"))
    scan = re.search(r"FileScan parquet \[item_id#\d+,day#\d+,loans.*", text).group()
    assert "GreaterThanOrEqual(day,1994-02-03)" in scan


def test_days_are_counted_anew_and_others_left(spark, tables, tmp_path):
    root, late = str(tmp_path), (dt.date(1996, 1, 1), dt.date(1996, 3, 31))
    some = F.to_date("loan_date").between(*late)
    before = tables["loans_items"].where(~some)
    older = store_daily(tables.having({"loans_items": before}), root, ["loans_daily"])
    seen = rows(older["loans_daily"])
    now = upkeep.refresh_daily(tables, root, *late)
    expected = rows(courses.loans_daily(tables))
    assert rows(now["loans_daily"]) == expected != seen == rows(older["loans_daily"])
    assert rows(upkeep.refresh_daily(tables, root, *late)["loans_daily"]) == expected  # once more
    gone = upkeep.refresh_daily(tables.having({"loans_items": before}), root, *late, layers=2)
    assert rows(gone["loans_daily"]) == seen and len(Snapshots(spark, root).info("loans_daily")["layers"]) == 1
    nothing = upkeep.refresh_daily(tables, root, late[1], late[0])
    assert rows(nothing["loans_daily"]) == seen == rows(stored(tables, root)["loans_daily"])


def test_loans_of_the_days_alone_are_read(tables):
    text = plan(courses.checkouts_daily(tables, dt.date(1996, 1, 1), dt.date(1996, 1, 31)))
    scan = re.search(r"FileScan parquet \[id#\d+,creation_date.*", text).group()
    assert re.search(r"creation_date#\d+ >= 1995-12-30", scan) and "LessThanOrEqual(cr" in scan


def test_all_relations_land(tables):
    assert all(tables.get(name) is not None for name in RELATIONS if name != "reserve_versions")


@pytest.fixture(scope="module")
def lookups(spark, tmp_path_factory):
    """Twenty times the items and check-ins, in small row groups."""
    given, copies = warehouse(spark, SF_DIR), spark.range(20).select(F.col("id").cast("string").alias("copy"))
    frames = {}
    for name, keys in {"item__t": ["id", "barcode"], "item__t__": ["id", "barcode"], "check_in__t": ["item_id"], "check_in__t__": ["item_id"]}.items():
        frame = given[name].crossJoin(copies)
        frames[name] = frame.withColumns({k: F.concat(k, F.lit("-"), "copy") for k in keys}).drop("copy")
    plain = Tables.of(spark, frames)
    return plain, store_lookups(plain, str(tmp_path_factory.mktemp("lookups")), 8, **{"parquet.block.size": "65536", "parquet.page.row.count.limit": "1000"})


@pytest.mark.parametrize("name", ["count_circulation_history", "count_internal_use"])
def test_lookups_skip_row_groups(name, lookups):
    plain, by_key = lookups
    arguments = {"barcode_to_check": "B12-7"}
    expected = rows(run(plain, name, **arguments))
    frame = run(by_key, name, **arguments)
    scans = read_by(frame)
    assert rows(frame) == expected and expected != ["Row(internal_use_count=0)"]
    check_ins = [n for columns, n in scans if "item_status_prior_to_check_in" in columns]
    items = [n for columns, n in scans if "barcode" in columns]
    assert max(check_ins) * 4 < plain["check_in__t"].count() and max(items) * 4 < plain["item__t__"].count()


def test_a_barcode_nobody_has(lookups):
    _, by_key = lookups
    assert run(by_key, "count_circulation_history", barcode_to_check="none").count() == 0
    assert rows(run(by_key, "count_internal_use", barcode_to_check="none")) == ["Row(internal_use_count=0)"]
