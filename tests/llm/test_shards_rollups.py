import re

import numpy as np
import pytest

from biblioscope.llm import queries, rollups, shards
from tests.llm.conftest import SF_DIR, WORD


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_order_is_a_permutation_with_an_inverse(n):
    order = shards.Order(n, b"key")
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.indexes(slots).tolist() == list(range(n))
    assert n < 64 or (slots != shards.Order(n, b"other").slots(np.arange(n))).any()


def test_shards_hold_all_texts_in_slot_order(spark, documents, tokenizer, tmp_path):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    folder = f"file://{tmp_path}/shards"
    index = shards.write(df, tokenizer, folder, b"key", end=50_256, stride=128, per_shard=60)
    rows = sorted(index.collect(), key=lambda r: r["slot"])
    again = sorted(index.collect(), key=lambda r: r["slot"])  # a second attempt leaves the same
    assert rows == again and [r["slot"] for r in rows] == list(range(len(documents)))
    texts, encoder = {d[0]: d[1] for d in documents}, None
    assert sorted(p.name for p in (tmp_path / "shards").iterdir()) == [shards.name(k) for k in range(4)]
    from biblioscope.llm import bpe

    encoder = bpe.Encoder(tokenizer._sent.value)
    for shard in range(4):
        stream = np.concatenate(list(shards.read(folder, shard, stride=128)))
        assert len(stream) % 128 == 0
        for row in (r for r in rows if r["shard"] == shard):
            at = row["row"] * 128 + row["place"]
            ids = stream[at : at + row["n_tokens"]]
            assert stream[at + row["n_tokens"]] == 50_256
            assert encoder.decode(ids.astype(np.int64))[0].tobytes().decode() == texts[row["doc_id"]]
        later = np.concatenate(list(shards.read(folder, shard, row=2, stride=128)))
        assert later.tolist() == stream[256:].tolist()


def test_shards_of_odd_rows(spark, odd, none, tokenizer, tmp_path):
    odd.write.parquet(str(tmp_path / "odd"))
    none.write.parquet(str(tmp_path / "none"))
    index = shards.write(spark.read.parquet(str(tmp_path / "odd")), tokenizer, f"file://{tmp_path}/a", b"k", end=50_256).collect()
    assert sorted(r["slot"] for r in index) == list(range(9))
    assert [r["n_tokens"] for r in index if r["doc_id"] in (1, 2)] == [0, 0]
    assert shards.write(spark.read.parquet(str(tmp_path / "none")), tokenizer, f"file://{tmp_path}/b", b"k", end=50_256).collect() == []


def test_index_query(spark, documents):
    rows = queries.op2_training_order(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == [d[0] for d in documents] and len({r["slot"] for r in rows}) == len(rows)


def changes(spark, rows):
    return spark.createDataFrame(rows, rollups._CHANGES)


def totals(rollup):
    return sorted((str(r["source"]), str(r["lang"]), r["tokenizer"], r["docs"], r["tokens"]) for r in rollup.totals().collect())


def test_batches_add_up_once_in_any_order(spark, tmp_path):
    one = changes(spark, [("a", "en", "v1", 1, 10), ("a", "en", "v1", 1, 5), (None, None, "v1", 1, 3)])
    two = changes(spark, [("a", "en", "v1", -1, -10), ("a", "en", "v1", 1, 12), ("b", "en", "v2", 1, 0)])
    three = changes(spark, [(None, None, "v1", -1, -3)])
    expected = [("a", "en", "v1", 2, 17), ("b", "en", "v2", 1, 0)]
    for k, order in enumerate([(1, 2, 3), (3, 2, 1)]):
        rollup = rollups.Rollup(spark, str(tmp_path / f"r{k}"))
        assert totals(rollup) == []
        for i in order:
            assert rollup.commit(f"b{i}", (one, two, three)[i - 1])
        assert not rollup.commit("b2", two)
        assert totals(rollup) == expected and rollup.batches() == {"b1", "b2", "b3"}
        small = rollup.compact(str(tmp_path / f"c{k}"))
        assert totals(small) == expected and not small.commit("b1", one)
        assert small.commit("b4", one.where("false")) and totals(small) == expected


def test_a_broken_batch_is_not_counted_and_can_be_sent_again(spark, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path / "r"))
    rows = changes(spark, [("a", "en", "v", 1, 10)])
    rollup.commit("x", rows)
    (tmp_path / "r" / "batch=x" / "_SUCCESS").unlink()
    assert totals(rollup) == [] and rollup.commit("x", rows)
    assert totals(rollup) == [("a", "en", "v", 1, 10)]
    with pytest.raises(ValueError):
        rollup.commit("a/b", rows)


def test_query_agrees_with_counting_what_is_left(spark, documents, tokenizer):
    from biblioscope.llm import bpe

    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    encoder, expected = bpe.Encoder(tokenizer._sent.value), {}
    for doc_id, text, lang, source in documents:
        label = labels.get(doc_id)
        if label and label["quality"] == 0:
            continue
        if label and label["toxic"] == 1:
            text = re.sub(r"^[^\n]*\n?", "", text, count=1)
        raw = np.frombuffer(text.encode(), np.uint8)
        for version, n in (("words", len(WORD.findall(text))), ("byte_bpe_50k", len(encoder.encode(raw, np.array([0, len(raw)]))[0]))):
            old = expected.get((source, lang, version), (0, 0))
            expected[source, lang, version] = old[0] + 1, old[1] + n
    rows = queries.op3_token_rollup(spark, SF_DIR).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in rows} == expected


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_rows_among_keys(bits, spark, odd):
    keys = spark.createDataFrame([(3,), (3,), (5,), (77,), (None,)], "doc_id long")
    found = rollups.among(odd, keys, bits=bits)
    assert found.columns == odd.columns and sorted(r["doc_id"] for r in found.collect()) == [3, 3, 5]
    assert rollups.among(odd, keys.where("false"), bits=bits).count() == 0


def test_counts_of_odd_rows(odd, none, tokenizer):
    rows = rollups.counted(odd, {"words": None, "t": tokenizer}).collect()
    assert len(rows) == 18 and {r["tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert rollups.counted(none, {"words": None}).collect() == []
