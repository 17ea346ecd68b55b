"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from fixtures.operator_queries import OPERATOR_SQL
from fixtures.relations import SOURCES
from fixtures.report_queries import REPORT_SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = [*REPORT_SQL, *OPERATOR_SQL]
QUERIES, SQL = ({name: given[name] for name in NAMES} for given in (entry.queries(), entry.oracle_sql()))
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", [name for name in QUERIES if name.startswith("r")])
def test_report_agrees_with_sql_where_nothing_is_broadcast(name, spark, duck):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        test_query_agrees_with_sql(name, spark, duck)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(name, spark, duck):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    rows = [tuple(row[c] for c in columns) for row in frame.collect()]
    cursor = duck.execute(SQL[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(described) == columns
    assert {c: TYPES[t] for c, t in frame.dtypes} == described
    order = [list(described).index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    if name.startswith("op_sort_"):
        assert rows == expected
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))
