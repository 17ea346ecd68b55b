import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from biblioscope.llm import queries, ranking, rules, stats, toxicity
from biblioscope.llm.blocks import Block
from tests.llm.conftest import SF_DIR, WORD

BIG = "/root/testdata/sf0.1"


def block(*texts, lower=False):
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return Block(np.frombuffer(b"".join(raw), np.uint8), at, slice(0, len(texts)), lower)


def base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_base_counts_agree_with_brute_force(documents):
    texts = [d[1] for d in documents] + ["", "a", "a\na\n a\n\n\n", "\n", "a b a b a b a", "x y z x y z", "é é é é é", "b c", "b c", " ", "a\x1cb a"]
    found = stats.counts(block(*texts))
    got = np.stack([found[k] for k in stats.COUNTS[:5]], axis=1).tolist()
    assert got == [base(t) for t in texts]


def test_label_model_finds_what_rules_are_worth():
    draw = np.random.default_rng(1)
    good = draw.random(20_000) < 0.8
    v = np.zeros((20_000, len(rules.RULES)), dtype=np.int64)
    for r in range(6):
        v[:, r] = np.where(draw.random(20_000) < np.where(good, 0.01, 0.4), -1, 0)
    for r in range(6, 9):
        v[:, r] = np.where(draw.random(20_000) < np.where(good, 0.95, 0.2), 1, 0)
    patterns, n = np.unique(v, axis=0, return_counts=True)
    model = rules.fit_patterns(patterns, n)
    assert abs(model.prior - 0.8) < 0.03
    assert ((model.posterior(v) >= 0.5) == good).mean() > 0.97
    true = (v[good][:, 6] == 1).sum() / (v[:, 6] == 1).sum()
    assert abs(model.accuracy[rules.RULES[6]] - true) < 0.03


def test_rules_query(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op4_quality_rules(spark, SF_DIR).collect()}
    for doc_id, text, *_ in documents:
        row, want = rows[doc_id], base(text)
        assert [row[k] for k in rules.BASE] == want
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row["base_failed"] and row["kept"])


def test_rules_keep_the_good_and_drop_the_bad(spark):
    rows = queries.op4_quality_rules(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").where("not base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.005 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.02 * counts[0, False]


def test_rules_of_odd_rows(odd, none):
    model = rules.fit(odd)
    rows = rules.judged(odd, model).collect()
    assert len(rows) == 9 and [r["base_failed"] for r in rows if r["doc_id"] in (1, 2, 6)] == [True] * 3
    assert [r["n_words"] for r in rows if r["doc_id"] == 5] == [80_000]
    kept = rules.filtered(odd, model)
    assert kept.schema == odd.schema and [r["doc_id"] for r in kept.collect()] == [r["doc_id"] for r in rows if r["kept"]]
    assert rules.judged(none, rules.fit(none)).collect() == []


def test_held_out_row_is_the_crc_of_its_id(spark):
    for row in spark.range(300).select("id", ranking.remainder(F.col("id"), 3).alias("r")).collect():
        assert row["r"] == zlib.crc32(str(row["id"]).encode()) % 3


def test_sample_is_bounded_and_has_one_row_a_key(spark):
    labels = spark.createDataFrame([(i % 50, i % 2, None) for i in range(200)] + [(None, 1, 1), (7, None, 1)], "doc_id long, quality int, toxic int")
    rows = ranking.sample(labels, "quality", F.lit(True), limit=20).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 20
    assert ranking.sample(labels, "toxic", F.lit(True)).count() == 1


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    return (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize(("query", "label", "least"), [("op5_quality_ranking", "quality", 0.99), ("op9_toxicity", "toxic", 0.93)])
def test_held_out_labels(query, label, least, spark):
    rows = queries.QUERIES[query](spark, BIG)
    assert rows.where("score is null or score < 0 or score > 1 or predicted != int(score >= 0.5)").count() == 0
    seen = rows.where("held_out").join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    y, s = np.array([r[label] for r in seen]), np.array([r["score"] for r in seen])
    assert auc(y, s) > least and ((s >= 0.5) == y).mean() > 0.97


def test_pairwise_fit_orders_by_preference():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] > 1.0).astype(int)
    model = ranking.fit_pairs(x, y)
    assert auc(y, model.score(x)) > 0.99 and abs((model.score(x) < 0.5).sum() - (y == 0).sum()) <= 1
    assert (ranking.fit_pairs(x, np.ones(400, dtype=int)).score(x) == 0.5).all()


def test_noisy_or_gradient_and_location(spark):
    texts = ["good day to all. you awful person. more words", "good day to all. more words", "Awful! nice", "nice day. good words\nto all"] * 30
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = spark.createDataFrame([(i, int("wful" in t)) for i, t in enumerate(texts)], "doc_id long, label int")
    model = toxicity.fit(documents, labelled)
    for row in toxicity.scored(documents, model).collect():
        bad = "wful" in row["text"]
        assert (row["score"] >= 0.5) == bad
        assert [row["text"].encode()[a:b].decode().strip() for a, b in row["offending"]] == ([next(s for s in ("you awful person.", "Awful!") if s in row["text"])] if bad else [])


def test_noisy_or_is_the_product():
    p = np.array([0.1, 0.5, 0.2, 1.0, 0.3])
    assert np.allclose(toxicity.noisy_or(p, np.array([0, 2, 2, 3, 5])), [0.55, 0.0, 0.2, 1.0])


@pytest.mark.parametrize("module", [ranking, toxicity])
def test_scores_of_odd_rows(module, spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (5, 0), (7, 1), (99, 0)], "doc_id long, label int")
    model = module.fit(odd, labels)
    rows = module.scored(odd, model).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert module.scored(none, module.fit(none, labels)).collect() == []
    assert module.scored(odd, module.fit(odd, labels.where("label = 1"))).count() == 9
