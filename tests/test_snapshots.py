"""Versions of stored tables: layers, readers, writers that break off, and derived tables kept up to date."""

import pytest
from pyspark.sql import functions as F

from biblioscope import Tables, refresh_derived, run, store_derived, stored
from biblioscope.operators.history import changed_between
from biblioscope.plans import upkeep
from biblioscope.sources.snapshots import Snapshots
from fixtures.relations import RELATIONS
from fixtures.warehouse import warehouse

SF_DIR = "/root/testdata/sf0.001"
BEFORE, NOW = "2020-01-01 00:00:00", "2024-01-01 00:00:00"


def rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.fixture
def store(spark, tmp_path):
    return Snapshots(spark, str(tmp_path))


def of(spark, pairs):
    return spark.createDataFrame(pairs, "k string, n int, v string")


def contents_of(store, version=None):
    return [tuple(r) for r in store.read("t", version).collect()]


def test_newer_layers_speak_for_their_keys(spark, store):
    first = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("c", 1, "x"), (None, 1, "none")]
    assert store.put("t", of(spark, first), ["k"], ["k", "n"]) == 1
    keys = spark.createDataFrame([("a",), ("b",), ("d",), ("a",)], "k string")
    assert store.change("t", of(spark, [("a", 3, "new"), ("d", 1, "new")]), keys, as_of="now") == 2
    assert store.change("t", of(spark, [("b", 9, "back")]), keys.where("k != 'a'")) == 3
    assert set(contents_of(store, 2)) == {("a", 3, "new"), ("d", 1, "new"), ("c", 1, "x"), (None, 1, "none")}
    assert set(contents_of(store, 3)) == {("a", 3, "new"), ("b", 9, "back"), ("c", 1, "x"), (None, 1, "none")}
    assert store.info("t")["as_of"] == "now"
    assert store.compact("t") == 4 and len(store.info("t")["layers"]) == 1
    assert set(contents_of(store)) == set(contents_of(store, 3))


def test_a_reader_ends_on_the_version_it_began_with(spark, store):
    store.put("t", of(spark, [("a", 1, "x"), ("b", 1, "x")]), ["k"])
    reader = store.read("t")
    store.change("t", of(spark, [("a", 1, "new")]), spark.createDataFrame([("a",)], "k string"))
    store.compact("t")
    store.put("t", of(spark, []), ["k"])
    assert sorted(tuple(r) for r in reader.collect()) == [("a", 1, "x"), ("b", 1, "x")]
    assert store.read("t").count() == 0
    store.expire("t", keep=2)
    assert store.versions("t") == [3, 4] and len(store._names(f"{store.root}/t/data")) == 2
    assert set(contents_of(store, 3)) == {("a", 1, "new"), ("b", 1, "x")}


def test_a_writer_that_breaks_off_leaves_the_older_version(spark, store, monkeypatch):
    store.put("t", of(spark, [("a", 1, "x")]), ["k"], aside={"codes": spark.range(3)})
    key = spark.createDataFrame([("a",)], "k string")
    failing = of(spark, [("a", 1, "new")]).withColumn("v", F.raise_error(F.lit("broken off")))
    for write in (lambda: store.change("t", failing, key), lambda: store.put("t", failing, ["k"])):
        with pytest.raises(Exception, match="broken off"):
            write()
    monkeypatch.setattr(Snapshots, "_publish", lambda *x: (_ for _ in ()).throw(OSError("power cut")))
    with pytest.raises(OSError):
        store.change("t", of(spark, [("a", 1, "new")]), key)
    monkeypatch.undo()
    assert store.versions("t") == [1] and contents_of(store) == [("a", 1, "x")]
    store.expire("t")
    assert len(store._names(f"{store.root}/t/data")) == 1
    assert store.aside("t", "codes").count() == 3
    assert store.change("t", of(spark, []), key) == 2 and contents_of(store) == []


def test_of_two_writers_of_a_version_one_fails(spark, store):
    store.put("t", of(spark, [("a", 1, "x")]), ["k"])
    info = store.info("t")
    store.change("t", of(spark, []), spark.createDataFrame([("a",)], "k string"))
    with pytest.raises(RuntimeError, match="meanwhile"):
        store._publish("t", {**info, "version": 2})
    assert store.versions("t") == [1, 2] and contents_of(store) == []


def test_a_table_is_clustered_by_its_key(spark, store):
    store.put("t", spark.range(1000).select(F.col("id").cast("string").alias("item_id")), ["item_id"], partitions=4)
    bounds = store.read("t").groupBy(F.input_file_name()).agg(F.min("item_id"), F.max("item_id")).collect()
    ranges = sorted((low, high) for _, low, high in bounds)
    assert store.read("t").count() == 1000 and len(ranges) == 4
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_what_is_not_there(spark, store):
    with pytest.raises(KeyError):
        store.read("t")
    store.put("t", of(spark, []), ["k"])
    assert store.read("t").columns == ["k", "n", "v"] and store.tables() == ["t"]
    with pytest.raises(KeyError):
        store.read("t", 7)
    with pytest.raises(KeyError):
        store.aside("t", "codes")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The warehouse's relations as files; histories lie by time, as they come in."""
    root = str(tmp_path_factory.mktemp("landed"))
    given = warehouse(spark, SF_DIR)
    for name in RELATIONS:
        if name in ("item__", "item__t__", "instance__", "instance__t__"):
            given[name].repartitionByRange(8, "__start", "id").sortWithinPartitions("__start").write.parquet(f"{root}/{name}")
        elif name != "reserve_versions":
            given[name].coalesce(1).write.parquet(f"{root}/{name}")
    return Tables.parquet(spark, root)


DERIVED = ["item_ext", "instance_ext", "item_circulation_notes"]


def test_refreshed_tables_are_those_made_anew(landed, tmp_path):
    root = str(tmp_path)
    former = landed["location__t"].withColumn("name", F.concat(F.lit("former "), "name")).where("id != '3'")
    older = store_derived(landed.having({"location__t": former}), root, as_of=BEFORE)
    before = {name: rows(run(older, name)) for name in DERIVED}
    now = refresh_derived(landed, root, NOW)
    for name in DERIVED:
        assert rows(run(now, name)) == rows(run(landed, name)) != before[name]
        assert rows(run(older, name)) == before[name]  # a reader of the older version
    assert {name: len(Snapshots(landed.spark, root).versions(name)) for name in DERIVED} == dict.fromkeys(DERIVED, 2)
    refresh_derived(landed, root, NOW)  # nothing to do
    assert Snapshots(landed.spark, root).versions("item_ext") == [1, 2]
    refresh_derived(landed, root, "2025-01-01T00:00:00+00:00", layers=2)
    assert len(Snapshots(landed.spark, root).info("item_ext")["layers"]) == 1
    assert rows(run(stored(landed, root), "item_ext")) == rows(run(landed, "item_ext"))


def test_a_key_that_changed_in_one_source_only(landed, tmp_path):
    flat = landed["item__t__"]
    moved = flat.where("id = '2' and __current")
    ended = flat.where("not (id = '2' and __current)").unionByName(moved.withColumns({"__current": F.lit(False), "__end": F.lit("2021-01-01").cast("timestamp_ntz")}))
    changed = ended.unionByName(moved.withColumns({"barcode": F.lit("B-NEW"), "__start": F.lit("2021-01-01").cast("timestamp_ntz")}))
    tables = landed.having({"item__t__": changed, "item__t": landed["item__t"].withColumn("barcode", F.when(F.col("id") == "2", "B-NEW").otherwise(F.col("barcode")))})
    store_derived(landed, str(tmp_path), as_of="2020-12-01 00:00:00")
    now = refresh_derived(tables, str(tmp_path), NOW)
    assert rows(run(now, "item_ext")) == rows(run(tables, "item_ext"))
    assert run(now, "item_ext").where("barcode = 'B-NEW' and status_name is not null").count() == 1


def test_refreshing_needs_to_know_since_when(landed, tmp_path):
    store_derived(landed, str(tmp_path))
    with pytest.raises(ValueError, match="as_of"):
        refresh_derived(landed, str(tmp_path), NOW)
    with pytest.raises(KeyError):
        refresh_derived(landed, str(tmp_path / "nowhere"), NOW)


def read_by(frame):
    """Rows that each scan of the run plan put out, by the columns it read."""
    frame.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
            return walk(node)
        if "Scan parquet" in name:
            found.append((node.output().mkString(","), node.metrics().apply("numOutputRows").value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return found


def test_a_small_change_is_read_alone(spark, landed, tmp_path):
    """1 % of 40,000 documents changed: the rows laid over are made of these, without the others being read."""
    many = landed["item"].crossJoin(spark.range(200).withColumnRenamed("id", "copy"))
    many = many.withColumn("id", F.concat("id", F.lit("-"), "copy")).withColumn("late", F.col("copy") < 2)
    begin = F.when(F.col("late"), "2021-01-01").otherwise("2019-01-01").cast("timestamp")  # Spark bounds no scan by TIMESTAMP_NTZ
    history = many.withColumns({"__id": F.col("id"), "__start": begin, "__end": F.lit("9999-12-31").cast("timestamp")}).drop("late", "copy")
    history.repartitionByRange(20, "__start", "id").sortWithinPartitions("__start").write.parquet(f"{tmp_path}/item__")
    history = spark.read.parquet(f"{tmp_path}/item__")
    whole, late = history.count(), history.where("__start > timestamp '2020-06-01'").count()
    assert late * 100 == whole

    keys = changed_between(history, BEFORE, NOW).select(F.col("id").alias("item_id")).distinct()
    source = upkeep._sources(history, keys, "item_id", BEFORE, NOW)
    made = upkeep.DERIVED["item_circulation_notes"].make(Tables.of(spark, {"item": source}))
    for frame in (keys, made):
        assert 0 < sum(n for _, n in read_by(frame)) <= 0.06 * whole  # whole row groups at the border


def test_as_of_takes_current_tables_from_their_histories(landed):
    then = landed.as_of(BEFORE)
    assert then["item__t"].where("id like '%7' and barcode like 'OLD%'").count() == then["item__t"].where("id like '%7'").count() > 0
    assert rows(then["location__t"]) == rows(landed["location__t"])
    assert then["item"].where("id like 'gone%'").count() > 0 == landed.as_of(NOW)["item"].where("id like 'gone%'").count()
