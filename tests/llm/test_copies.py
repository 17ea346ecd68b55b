import random
import tracemalloc
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from biblioscope.llm import decontam, jaccard, queries
from biblioscope.llm.shared import components
from tests.llm.conftest import SF_DIR, WORD

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Component of each id by comparing all pairs."""
    sets, parent = defaultdict(list), {}
    for doc_id, text in rows:
        sets[doc_id].append(shingles(text))
        parent[doc_id] = doc_id

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(100 * len(s & t) >= 75 * len(s | t) for s in sets[a] for t in sets[b] if s and t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {a: find(a) for a in ids}


def families(seed):
    """Copies, chains of near copies around the threshold, and a passage that all share."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(12):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 4, 5, 6, 12, 40, 120]))]
        for _ in range(rnd.randrange(1, 7)):
            words = list(words)
            for _ in range(rnd.randrange(0, max(2, len(words) // 25))):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append(" ".join([*words, *(passage if rnd.random() < 0.4 else [])]))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(2))
def test_components_agree_with_all_pairs(seed, spark, work):
    rows = families(seed)
    found = jaccard.similar(work, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), often=3).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows)
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {d: len(shingles(t)) for d, t in rows}


def test_groups_only_save_work(spark, work):
    """Without grouping, all links come from the matrix."""
    rows = families(9)
    found = jaccard.similar(work, spark.createDataFrame(rows, "doc_id long, text string"), keys=0).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows)


def test_jaccard_query(spark, documents):
    rows = [(d[0], d[1]) for d in documents]
    found = queries.op6_ngram_jaccard(spark, SF_DIR).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows)


def test_jaccard_of_odd_rows(work, odd, none):
    found = jaccard.similar(work, odd).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr)
    assert len(got) == 9 and (None, 9, None) in got and got.count((3, 5, 3)) == 2 and (4, 5, 3) in got and (1, 0, 1) in got and (2, 0, 2) in got and (6, 0, 6) in got
    assert jaccard.similar(work, none).collect() == []


def test_rows_that_share_an_id(spark, work):
    a, b, c = "one two three four five six seven", "quite another text that has six words more", "a third text of nine words or so it is"
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (9, c), (9, ""), (11, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["component_id"]) for r in jaccard.similar(work, frame).collect()]
    assert sorted(found) == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 9), (9, 9), (9, 9), (11, 11)]
    found = [(r["doc_id"], r["component_id"]) for r in jaccard.similar(work, frame, ids=False).collect()]
    assert sorted(found) == [(3, 3), (5, 3), (5, 5), (7, 5), (9, 9), (9, 9), (9, 9), (11, 11)]


def test_ids_of_text(spark, work):
    a, b = "one two three four five six seven", "quite another text that has six words more"
    found = jaccard.similar(work, spark.createDataFrame([("07", a), ("7", a), ("x3", b), ("x3", b)], "doc_id string, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [("07", "07"), ("7", "07"), ("x3", "x3"), ("x3", "x3")]


def test_components_of_a_long_chain_and_a_star(spark, work):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 60)] + [(200, 200), (7, 5)]
    found = {r["node"]: r["component"] for r in components(work, spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(5, 60), 5)}


def contained(documents, items):
    of = {i: shingles(t) for i, t in items}
    return {(d, i, len(s), len(s & shingles(t))) for d, t in documents for i, s in of.items() if s and 100 * len(s & shingles(t)) >= 75 * len(s)}


@pytest.mark.parametrize("bits", [decontam.BITS, 64])
def test_containment_agrees_with_brute_force(bits, spark, work):
    """Bitmaps that are full lose nothing."""
    rnd = random.Random(4)
    vocabulary = [f"W{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([5, 6, 9, 20, 60])))) for i in range(30)]
    documents = []
    for d in range(120):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 3, 30, 400]))]
        for _ in range(rnd.randrange(3)):
            cut = rnd.choice(items)[1].lower().split()
            if rnd.random() < 0.5:
                cut[rnd.randrange(len(cut))] = "other"
            at = rnd.randrange(len(words) + 1)
            words[at:at] = cut[: max(4, int(len(cut) * rnd.choice([0.6, 0.8, 0.9, 1.0])))]
        documents.append((d, "\n".join(words)))
    found = decontam.contaminated(work, spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), bits=bits).collect()
    assert {(r["doc_id"], r["item_id"], r["n_item_shingles"], r["n_shared"]) for r in found} == contained(documents, items)
    assert len(found) == len(set(found)) > 20


def test_short_items_are_found_as_runs_of_words(spark, work):
    items = spark.createDataFrame([(1, "two Words"), (2, "one"), (3, ""), (4, None)], "item_id long, text string")
    documents = spark.createDataFrame([(1, "here are TWO words in a row of many"), (2, "words two"), (3, "one"), (4, None)], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(work, documents, items).collect()} == {(1, 1), (3, 2)}


def test_decontamination_query_agrees_with_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '/root/testdata/sf0.01/{name}.parquet'")
    result = connection.execute(queries.SQL["op8_decontamination"])
    names = [d[0] for d in result.description]
    expected = {tuple(r) for r in result.fetchall()}
    assert {tuple(r[n] for n in names) for r in queries.op8_decontamination(spark, "/root/testdata/sf0.01").collect()} == expected != set()


def test_decontamination_of_odd_rows(spark, work, odd, none):
    benchmark = spark.createDataFrame([(1, "same text here for two rows", "x"), (None, "without an id that is long enough", None)], "item_id long, text string, n string")
    found = decontam.contaminated(work, odd, benchmark)
    assert sorted(((r["doc_id"], r["item_id"]) for r in found.collect()), key=repr) == [(3, 1), (4, 1), (None, None)]
    left = decontam.clean(work, odd, benchmark)
    assert left.columns == odd.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 5, 6, 7]
    assert decontam.contaminated(work, none, benchmark).collect() == []
    assert decontam.clean(work, odd, benchmark.where("false")).count() == 9


def test_rows_without_an_id_are_cleaned_one_by_one(spark, work):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "only here as a whole")], "item_id long, text string")
    rows = [
        (None, "a clean text without an id"), (None, "see: only here as a whole"), (None, "see: only here as a whole"), (None, None), (None, ""),
        (None, "one two three four five six seven eight"), (None, "seven eight nine ten eleven twelve"),  # an item only together
        (7, "one two three four five six seven eight"), (7, "six seven eight nine ten eleven twelve"),  # one document
        (8, "a clean text with an id"), (9, "only here as a whole"),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            left = [tuple(r) for r in decontam.clean(work, documents, benchmark).collect()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert sorted(left, key=repr) == sorted([rows[i] for i in (0, 3, 4, 5, 6, 9)], key=repr)


def test_a_worker_hashes_little_at_once_and_counts_over_more():
    """Shingles of a few texts, far apart in 4 MB, are still found to be common; the worker holds what a block of 1 MB takes."""
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(2500)) for _ in range(200)]
    for i in range(0, 200, 22):
        texts[i] += " a passage of five words"
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    assert 3 << 20 < sum(map(len, texts)) < 4 << 20
    tracemalloc.start()
    rows = list(jaccard._features(iter([batch]), jaccard._ORDERS, 8, pa.int64()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
    common = [n for r in rows for is_common, n in zip(r["common"].to_pylist(), r["n"].to_pylist(), strict=True) if is_common]
    assert common == [10]
    assert sum(r.num_rows for r in rows) == 201
