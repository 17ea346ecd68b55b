import corpus_pipeline as pipeline
from biblioscope.llm import rules, surrogates
from tests.llm.conftest import SF_DIR
from tests.llm.test_copies import brute, contained


def test_stages_do_what_they_say(spark, work, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        out = work.stage(stage(spark, docs, SF_DIR))
        if name == "byte-level BPE":
            found = out.collect()
            assert sorted(r["doc_id"] for r in found) == sorted(rows) and all(r["round_trip"] for r in found)
            break
        assert out.columns == docs.columns
        new = {r["doc_id"]: r for r in out.collect()}
        if name == "quality rules":
            expected = {r["doc_id"] for r in rules.judged(docs, rules.fit(docs)).where("kept").collect()}
        elif name == "n-gram Jaccard join":
            expected = {d for d, c in brute([(d, r["text"]) for d, r in rows.items()]).items() if d == c}
        elif name == "benchmark decontamination":
            expected = rows.keys() - {d for d, *_ in contained([(d, r["text"]) for d, r in rows.items()], benchmark)}
        else:
            expected = rows.keys()
            for d, r in new.items():
                assert (r["text"] == rows[d]["text"]) == (not surrogates.find(rows[d]["text"])) and r["n_chars"] == len(r["text"])
        assert new.keys() == expected
        if name != "PII":
            assert all(new[d] == rows[d] for d in new)
        docs, rows = out, new


def test_run_is_the_stages(spark):
    rows = pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_stages_take_odd_and_no_rows(spark, odd, none):
    for docs in (odd, none):
        docs = docs.selectExpr("doc_id", "text", "lang", "source", "n_words as n_chars")
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        assert docs.columns[0] == "doc_id" and docs.count() <= 9


def test_texts_that_share_an_id_stay_apart(spark):
    a, b, c = "one two three four five six seven", "quite another text that has six words more", "a third text of nine words or so it is"
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (9, c), (9, ""), (11, None), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "1L as n_chars")
    left = [(r["doc_id"], r["text"]) for r in pipeline.near_copies(spark, docs, SF_DIR).collect()]
    assert sorted(left, key=repr) == sorted([(3, a), (5, b), (9, c), (9, ""), (11, None), (None, a), (None, a)], key=repr)


def test_one_of_rows_that_repeat_stays(spark, odd):
    docs = odd.selectExpr("doc_id", "text", "lang", "source", "n_words as n_chars")
    left = [r["doc_id"] for r in pipeline.near_copies(spark, docs, SF_DIR).collect()]
    assert sorted(left, key=repr) == [1, 2, 3, 5, 6, 7, None]
