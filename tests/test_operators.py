"""Operators against plain Python on small frames."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from biblioscope.functions import dates, documents, text
from biblioscope.functions import text as functions_text
from biblioscope.operators import aggregates, contract, history, joins, lookup, spans, unnest
from biblioscope.sources import staging
from biblioscope.sources.tables import Tables

DAY = dt.date(2024, 1, 1)


def values(frame):
    return [tuple(row) for row in frame.collect()]


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def text_lit(value):
    return F.lit(value).cast("string")


# --- counting in spans ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_count_in_spans_equals_all_pairs(spark, seed):
    pick = random.Random(seed)
    keys = ["hot"] * 8 + ["a", "b", None]
    day = lambda: pick.choice([None] + [DAY + dt.timedelta(pick.randrange(30)) for _ in range(12)])
    events = [(pick.choice(keys), day()) for _ in range(400)]
    ranges = [(pick.choice(keys), pick.choice("xy"), pick.choice(["p", None]), day(), day()) for _ in range(120)]
    expected = Counter(
        (k, x, p) for k, x, p, lo, hi in ranges for e, d in events
        if k is not None and k == e and None not in (lo, hi, d) and lo <= d <= hi
    )
    found = spans.count_in_spans(
        spark.createDataFrame(events, "k string, d date"),
        spark.createDataFrame(ranges, "k string, x string, p string, lo date, hi date"),
        on="k", by=["x", "p"], day="d", start="lo", end="hi", count="n",
    )
    assert {row[:3]: row[3] for row in values(found)} == expected


@pytest.mark.parametrize("hot", [0, 20])
def test_count_in_spans_spreads_the_spans_of_hot_keys(spark, hot):
    pick = random.Random(4)
    days = [DAY + dt.timedelta(i) for i in range(30)]
    events = [(pick.choice(["hot"] * 5 + ["a", "b"]), pick.choice([None, *days])) for _ in range(300)]
    ranges = [(pick.choice(["hot"] * 8 + ["a", "b", "none"]), pick.choice(["x", None]), *sorted(pick.choices(days, k=2))) for _ in range(150)]
    expected = Counter((k, x) for k, x, lo, hi in ranges for e, d in events if k == e and d is not None and lo <= d <= hi)
    found = spans.count_in_spans(
        spark.createDataFrame(events, "k string, d date"), spark.createDataFrame(ranges, "k string, x string, lo date, hi date"),
        on="k", by=["x"], day="d", start="lo", end="hi", count="n", hot=hot,
    )
    assert {row[:2]: row[2] for row in values(found)} == expected


def test_count_in_spans_takes_both_ends_and_skips_reversed_and_open_spans(spark):
    events = spark.createDataFrame([("a", DAY)] * 3, "k string, d date")
    before, after = DAY - dt.timedelta(1), DAY + dt.timedelta(1)
    ranges = [
        ("a", "that day", DAY, DAY), ("a", "after", after, after), ("a", "reversed", after, before),
        ("a", "open", DAY, None), ("a", "from sentinel", DAY, dt.date(9999, 12, 30)),
    ]
    frame = spark.createDataFrame(ranges, "k string, x string, lo date, hi date")
    found = spans.count_in_spans(events, frame, on="k", by=["x"], day="d", start="lo", end="hi", count="n")
    assert sorted(values(found)) == [("a", "from sentinel", 3), ("a", "that day", 3)]


# --- history ----------------------------------------------------------------------------------


def test_latest_per_key_equals_python(spark):
    pick = random.Random(7)
    times = [None] + [dt.datetime(2020, 1, d) for d in range(1, 9)]
    rows = [(pick.choice(["hot"] * 9 + list("abc")), pick.choice("xy"), pick.choice(times), i) for i in range(300)]
    newest = {}
    for row in rows:
        rank = (row[2] is None, row[2] or dt.datetime.min, row[3])
        if rank > newest.get(row[:2], (((False, dt.datetime.min, -1)), None))[0]:
            newest[row[:2]] = (rank, row)
    frame = spark.createDataFrame(rows, "k string, x string, __start timestamp_ntz, __id int")
    assert sorted(map(str, values(history.latest_per_key(frame, ["k", "x"])))) == sorted(
        str(row) for _, row in newest.values()
    )


def test_version_span_is_open_when_any_version_is(spark):
    d = lambda n: dt.datetime(2020, 1, n)
    rows = [("a", d(2), d(3)), ("a", d(1), d(2)), ("b", d(1), d(9)), ("b", d(2), None)]
    frame = spark.createDataFrame(rows, "id string, __start timestamp_ntz, __end timestamp_ntz")
    assert sorted(values(history.version_span(frame, "id"))) == [("a", d(1), d(3)), ("b", d(1), None)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_open_end_and_contract_hold_in_any_session_zone(spark, kind):
    zone = spark.conf.get("spark.sql.session.timeZone")
    text = F.lit("9999-12-31 00:00:00" + ("Z" if kind == "timestamp" else ""))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        frame = spark.range(1).select(text.cast(kind).alias("__end"))
        assert history.current_rows(frame).count() == 1
        for declared in ("timestamp", "timestamp_ntz"):
            conformed = contract.conform(frame, f"__end {declared}")
            assert history.current_rows(conformed).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_current_rows_by_flag_and_by_open_end(spark):
    flagged = spark.createDataFrame([(1, True), (2, False)], "id int, __current boolean")
    assert [r.id for r in history.current_rows(flagged).collect()] == [1]
    ends = [(1, dt.datetime(9999, 12, 31)), (2, dt.datetime(2020, 1, 1)), (3, None)]
    dated = spark.createDataFrame(ends, "id int, __end timestamp_ntz")
    assert sorted(r.id for r in history.current_rows(dated).collect()) == [1, 3]


def test_tables_take_a_missing_current_table_from_its_history(spark):
    versions = spark.createDataFrame([(1, True), (1, False)], "id int, __current boolean")
    tables = Tables.of(spark, {"item__t__": versions})
    assert tables["item__t"].count() == 1 and tables["item__t__"].count() == 2
    with pytest.raises(KeyError):
        tables["instance"]


def test_tables_from_parquet_and_catalog(spark, tmp_path):
    frame = spark.createDataFrame([("1", "Stacks")], "id string, name string")
    frame.write.parquet(str(tmp_path / "location__t"))
    assert values(Tables.parquet(spark, str(tmp_path))["location__t"]) == [("1", "Stacks")]
    paths = {"location__t": str(tmp_path / "location__t")}
    assert values(Tables.parquet(spark, paths)["location__t"]) == [("1", "Stacks")]
    frame.createOrReplaceTempView("stacks")
    assert values(Tables.catalog(spark, {"location__t": "stacks"})["location__t"]) == [("1", "Stacks")]
    assert Tables.catalog(spark, {"location__t": "stacks"}).get("item") is None


# --- joins and lookups ------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    many = [("hot" if i % 3 else f"k{i}", i) for i in range(90)] + [(None, -1)]
    left = spark.createDataFrame(many, "k string, v int")
    right = spark.createDataFrame([("hot", "H"), ("k3", "K"), ("unused", "U")], "k string, w string")
    plain = left.join(right, "k", how)
    assert Counter(values(joins.spread_join(left, right, "k", how))) == Counter(values(plain))


def test_only_keeps_repeated_rows_once_each(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    keys = spark.createDataFrame([("a", 0), ("a", 1), (None, 2)], "k string, x int")
    assert values(joins.only(frame, keys, "k")) == [("a", 1), ("a", 1)]
    assert joins.only(frame, keys.where("false"), "k").count() == 0


def test_latest_row_without_an_id_is_told_by_its_other_columns(spark):
    rows = [("a", "2024", "x", 1), ("a", "2024", "y", 0), ("a", "2023", "z", 9)]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "id string, __start string, t string, n int").repartition(3)
        assert values(history.latest_per_key(frame, ["id"])) == [("a", "2024", "x", 1)]


def test_with_name_keeps_unknown_and_missing_ids(spark):
    codes = spark.createDataFrame([("1", "one")], "id string, name string")
    rows = spark.createDataFrame([("1",), ("2",), (None,)], "key string")
    assert Counter(values(lookup.with_name(rows, codes, "key", "label"))) == Counter(
        [("1", "one"), ("2", None), (None, None)]
    )


# --- unnesting and text aggregation -----------------------------------------------------------


def test_unnest_numbers_from_one_and_drops_rows_without_elements(spark):
    docs = ['{"n": [{"a": "x"}, {"a": 5}, {}]}', '{"n": []}', "{}", '{"n": null}', '{"n": "text"}', None]
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, jsonb string")
    rows = unnest.unnest_json(frame, "jsonb", "n", documents.text_fields("a"), "e", "ord")
    assert values(rows.select("id", "e.a", "ord")) == [(0, "x", 1), (0, "5", 2), (0, None, 3)]


def test_joined_texts_repeat_in_order_and_skip_nulls(spark):
    rows = [("k", "b"), ("k", "a"), ("k", "b"), ("k", None), ("n", None)]
    counts = aggregates.text_counts(spark.createDataFrame(rows, "k string, t string"), "k", "t", "ts")
    assert values(counts.select("k", aggregates.joined_texts("ts", "t", ", "))) == [("k", "a, b, b")]
    assert values(counts.select(aggregates.joined_texts("ts", "t", ", ", F.lit(2)))) == [("a, a, b, b, b, b",)]


# --- contracts and order ----------------------------------------------------------------------


def test_conform_renames_by_position_and_casts(spark):
    frame = spark.range(1).select(
        F.lit(3).cast("bigint"), F.lit(True), F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"), F.lit(2)
    )
    schema = "n int, flag string, day date, total decimal(38,0)"
    result = contract.conform(frame, schema)
    assert values(result) == [(3, "true", dt.date(2024, 5, 6), 2)]
    assert [f.dataType.simpleString() for f in result.schema] == ["int", "string", "date", "decimal(38,0)"]
    with pytest.raises(ValueError):
        contract.conform(frame, "n int")


def test_sorted_by_places_nulls_like_the_database(spark):
    frame = spark.createDataFrame([(None,), (1,), (2,)], "v int")
    assert values(contract.sorted_by(frame, "v")) == [(1,), (2,), (None,)]
    assert values(contract.sorted_by(frame, "-v")) == [(None,), (2,), (1,)]


# --- text -------------------------------------------------------------------------------------


def test_concat_skips_null(spark):
    assert one(spark, text.skip_null_concat(F.lit("a"), text_lit(None), F.lit("b"))) == ("ab",)


def test_ci_match_folds_case_beyond_ascii_and_keeps_null(spark):
    assert one(
        spark,
        text.ci_match(F.lit("LES ÉTUDES"), "études"),
        text.ci_match(text_lit(None), "x"),
        ~text.ci_match(text_lit(None), "x"),
        text.ci_match(F.lit("x"), None),
        text.ci_match(F.lit("first\nsecond"), "T.S"),
    ) == (True, None, None, None, True)


def test_invalid_pattern_raises(spark):
    with pytest.raises(Exception, match="(?i)pattern|regex"):
        spark.createDataFrame([("a",)], "v string").where(text.ci_match(F.col("v"), "(")).collect()


@pytest.mark.parametrize(
    "prefix, number, volume, copy, expected",
    [
        ("Curr", "QA1", "v.2", "3", "Curr QA1 v.2 c.3"),
        (None, "QA1", None, "1", "QA1"),
        (None, "QA1", None, None, "QA1"),
        ("Curr", None, "v.2", "3", "copied"),
    ],
)
def test_call_number(spark, prefix, number, volume, copy, expected):
    parts = [text_lit(v) for v in (prefix, number, volume, copy)]
    assert one(spark, text.call_number(*parts, F.lit("copied"))) == (expected,)


def test_class_list_call_number_repeats_the_number_and_keeps_blanks(spark):
    parts = [text_lit(v) for v in ("Curr", "QA1", None, "1")]
    assert one(spark, text.class_list_call_number(*parts)) == ("Curr QA1 QA1  1",)


def test_record_link_cuts_ids_starting_with_b(spark):
    links = [text.record_link(F.lit(h), "u/") for h in ("b12345678", "B12345678", "in001")]
    assert one(spark, *links) == ("u/b1234567", "u/B12345678", "u/in001")


# --- dates ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "instant, day",
    [
        ("2024-07-01 06:59:59", "2024-06-30"),
        ("2024-07-01 07:00:00", "2024-07-01"),
        ("2024-01-15 07:59:59", "2024-01-14"),
        ("2024-01-15 08:00:00", "2024-01-15"),
        ("9999-12-31 00:00:00", "9999-12-30"),
        (None, None),
    ],
)
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_local_day(spark, instant, day, kind):
    frame = spark.range(1).select(text_lit(instant).cast(kind).alias("t"))
    expected = day and dt.date.fromisoformat(day)
    assert frame.select(dates.local_day(frame, "t")).first()[0] == expected


def test_later_and_earlier_keep_null_of_the_second_side(spark):
    none = F.lit(None).cast("int")
    assert one(
        spark,
        dates.later_of(F.lit(2), F.lit(1)), dates.later_of(F.lit(1), none), dates.later_of(none, F.lit(1)),
        dates.earlier_of(F.lit(2), F.lit(1)), dates.earlier_of(F.lit(1), none), dates.earlier_of(none, F.lit(1)),
    ) == (2, None, 1, 1, None, 1)


def test_day_range_takes_the_whole_end_day_and_midnight_range_does_not(spark):
    at = [F.lit(f"2024-01-02 00:00:0{s}").cast("timestamp_ntz") for s in (0, 1)]
    assert one(spark, *[dates.in_day_range(t, DAY, dt.date(2024, 1, 2)) for t in at]) == (True, True)
    assert one(spark, *[dates.in_midnight_range(t, DAY, dt.date(2024, 1, 2)) for t in at]) == (True, False)


# --- documents --------------------------------------------------------------------------------


def test_json_text_of_absent_steps_and_booleans(spark):
    doc = F.lit('{"a": {"b": [true]}, "n": null}')
    assert one(
        spark,
        documents.json_text(doc, "a", "b", 0), documents.json_text(doc, "a", "b", 1),
        documents.json_text(doc, "x", "y"), documents.json_text(doc, "n"),
    ) == ("true", None, None, None)


def test_absent_or_false_reads_json_and_text_booleans(spark):
    docs = ['{"s": false}', '{"s": "false"}', "{}", '{"s": true}', '{"s": "true"}']
    assert one(spark, *[documents.absent_or_false(F.lit(d), "s") for d in docs]) == (True, True, True, False, False)


def test_json_instant_is_utc_whatever_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        instant = documents.json_instant(F.lit("2021-01-02T03:04:05+02:00"))
        assert one(spark, instant) == (dt.datetime(2021, 1, 2, 1, 4, 5),)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- staging ----------------------------------------------------------------------------------


def test_kept_sets_are_noted_for_their_report_alone(spark):
    with staging.keeping() as one:
        first = staging.kept(spark.range(3).toDF("a"))
        with staging.keeping() as two:
            staging.kept(spark.range(4).toDF("b"))
        staging.kept(first.where("a > 0"))
    staging.kept(spark.range(5).toDF("c"))
    assert [f.columns for f in one] == [["a"], ["a"]] and [f.columns for f in two] == [["b"]]
    report = first.withColumn("x", F.lit(1))
    report._kept = one
    staging.release(report)
    assert not first.is_cached and two[0].is_cached and report.count() == 3
    spark.catalog.clearCache()


def test_grouping_helper_is_exact_on_a_hot_group(spark):
    """A third of all rows under one key: same counts as Python's."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", f"t{i % 7}") for i in range(3000)]
    expected = defaultdict(Counter)
    for key, value in rows:
        expected[key][value] += 1
    counts = aggregates.text_counts(spark.createDataFrame(rows, "k string, t string"), "k", "t", "ts")
    found = {row.k: {c.t: c.times for c in row.ts} for row in counts.collect()}
    assert found == {key: dict(counter) for key, counter in expected.items()}


@pytest.mark.parametrize(
    ("pattern", "text", "found"),
    [
        ("c$", "abc", True), ("c$", "abc\n", False), (r"c\Z", "abc\n", False), ("^b", "a\nb", False), ("a.b", "a\nb", True),
        ("[[:alpha:]]", "1x2", True), ("^[[:alpha:]]+$", "xé", True), ("[[:digit:][:space:]]", "ab", False), ("[^[:alpha:]]", "a", False),
        (r"\mcat\M", "the cat sat", True), (r"\mcat\M", "concat", False), (r"\ycat", "a cat", True), (r"a\Yb", "ab", True),
        ("[[:<:]]cat[[:>:]]", "cat!", True), ("[]a]", "]", True), ("[a&&b]", "&", True), ("[a[]", "[", True), (r"[\d-]", "-", True),
        (r"\x41", "a", True), (r"(a)\1", "aa", True), (r"\.", "x", False), ("a{2}", "aa", True), ("(?:a|b)c", "bc", True),
    ],
)
def test_patterns_are_the_databases(spark, pattern, text, found):
    assert one(spark, functions_text.ci_match(F.lit(text), pattern)) == (found,)


@pytest.mark.parametrize(("text", "value"), [("on", True), (" OFF ", False), ("of", False), ("tru", True), ("0", False), ("Yes", True), (None, None)])
def test_booleans_are_the_databases(spark, text, value):
    assert one(spark, documents.text_bool(F.lit(text).cast("string"))) == (value,)


def test_texts_in_the_order_of_a_collation(spark):
    words = ["zebra", "Äpfel", "apfel", "Apfel", "éclair", "Eclair", "école", "Zoo", "a b", "ab", "a-c", "10", "9", None, "b"]
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i int").repartition(3)
    plain = [r["w"] for r in contract.sorted_by(frame, "w", "i").collect()]
    with contract.collated("UNICODE"):
        up, down = contract.sorted_by(frame, "w", "i"), contract.sorted_by(frame, "-w", "i")
    expected = ["10", "9", "a b", "a-c", "ab", "apfel", "Apfel", "Äpfel", "b", "Eclair", "éclair", "école", "zebra", "Zoo", None]
    assert [r["w"] for r in up.collect()] == expected
    assert [r["w"] for r in down.collect()] == expected[::-1]
    assert plain == sorted(filter(None, words)) + [None]


@pytest.mark.parametrize("bits", [joins.FILTER_BITS, 1024, 64])
def test_likely_keeps_what_the_join_keeps(spark, bits):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    keys = spark.createDataFrame([(str(i),) for i in range(0, 3000, 100)] * 2 + [(None,), ("other",)], "c string")
    left = joins.likely(rows, "k", keys, "c", bits=bits)
    assert sorted(r.k for r in left.join(keys.distinct(), left.k == keys.c).collect()) == sorted(str(i) for i in range(0, 3000, 100))
    assert left.count() < {joins.FILTER_BITS: 40, 1024: 300, 64: 3002}[bits]
    assert joins.likely(rows, "k", keys.where("false"), "c", bits=bits).count() == 0
