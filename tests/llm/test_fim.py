import hashlib
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from biblioscope.llm import fim, queries
from tests.llm.conftest import SF_DIR

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text):
    """One unit after the other."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, rows):
    frame = fim.transformed(spark.createDataFrame(rows, "doc_id long, text string"))
    found = frame.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found]
    assert sorted(map(repr, got)) == sorted(repr((d, *by_hand(d, t))) for d, t in rows)
    assert sorted(map(repr, ((r["doc_id"], r["again"]) for r in found))) == sorted(repr((d, t or "")) for d, t in rows)
    return found


def test_given_documents(spark, documents):
    assert {r["form"] for r in check(spark, [row[:2] for row in documents])} == {"plain", "spm", "psm"}


def test_query_is_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    found = queries.QUERIES["op11_fill_in_middle"](spark, SF_DIR)
    expected = connection.execute(queries.SQL["op11_fill_in_middle"])
    names = [d[0] for d in expected.description]
    assert sorted(tuple(r[n] for n in names) for r in found.collect()) == sorted(expected.fetchall())
    assert sorted(names) == sorted(found.columns)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("ab \t\n\x0b\x1c\xa0é🙂<PSM>"), max_size=40), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_are_those_of_the_units(text, h1, h2):
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    assert fim.cut(text, h1, h2) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def test_marks_blanks_and_broken_marks(spark):
    texts = ["a <P> b", "a<S>", "<M>", "<", "<P", "P><S", "M><", "< P>", " \n\t ", "a", " a", "a ", "🙂 é\u2028b\xa0c", None, ""]
    check(spark, [(i, t) for i, t in enumerate(texts * 40)])


def test_other_shares(spark):
    frame = spark.createDataFrame([(i, f"a{i} b c") for i in range(50)], "doc_id long, text string")
    assert {r["form"] for r in fim.transformed(frame, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.transformed(frame, rate=100, spm=0).collect()} == {"psm"}


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_odd_and_no_rows(spark, rows, request):
    frame = request.getfixturevalue(rows).selectExpr("*", "'x' as output", "array(1) as n", "'x' as form")
    found = fim.transformed(frame)
    assert [c for c in found.columns if c not in frame.columns] == ["prefix_chars", "middle_chars"]
    again = found.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(again) == frame.count() and all(r["again"] == (r["text"] or "") and r["ids"] == "x" for r in again)


def test_bytes_that_are_no_utf8_come_back(spark):
    frame = spark.range(40).selectExpr("id as doc_id", "cast(concat(cast('a ' as binary), x'ff20c3', cast(' b <c' as binary)) as string) as text")
    found = fim.transformed(frame).withColumn("again", fim.restored(F.col("output"), F.col("form")))
    assert found.where("cast(again as binary) <> cast(text as binary) or n <> 5").count() == 0
    assert found.where("form <> 'plain'").count() > 0
