import re

import duckdb
import pytest

from biblioscope.llm import queries
from biblioscope.llm.shared import Work

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="session")
def work(spark):
    work = Work(spark)
    yield work
    work.release()


@pytest.fixture(scope="session")
def tokenizer(spark):
    return queries.tokenizer(spark)


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns named as the operators' results are."""
    long = " ".join(f"word{i % 977} and{i}" for i in range(40_000)) + "."
    rows = [
        (1, None, "en", None, 7), (2, "", None, "a", 7), (None, "a text without an id that is long enough to be a shingle", "en", "a", 7),
        (3, "same text here for two rows of a kind", "en", "a", 7), (3, "same text here for two rows of a kind", "en", "a", 7),
        (4, "same text here for two rows of a kind", None, "a", 7), (5, long, "en", "a", 7), (6, "   \n\t\n ", "en", "a", None), (7, "ÄÖ ü ß 中文 🙂", "xx", "a", 7),
    ]
    names = "doc_id long, text string, lang string, source string, n_words long"
    extra = spark.createDataFrame(rows, names)
    for name in ("ids", "score", "kept", "n_entities", "component_id", "token"):
        extra = extra.selectExpr("*", f"'x' as {name}")
    return extra


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
