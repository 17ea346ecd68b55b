"""The driver's entry file imports and registers the reports, whatever of the training-data operators is missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from fixtures.operator_queries import OPERATOR_QUERIES
from fixtures.report_queries import REPORT_QUERIES

ROOT = Path(__file__).resolve().parent.parent

HIDDEN = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if any(name == x or name.startswith(x + ".") for x in {names!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__
print(*sorted(__spark_entry__.queries()))
print(*sorted(__spark_entry__.oracle_sql()))
"""


@pytest.mark.parametrize(
    "names",
    [("biblioscope.llm", "corpus_pipeline"), ("biblioscope.llm",), ("public_tokenizers",), ("regex",), ("numpy",)],
    ids=lambda names: "+".join(names),
)
def test_the_reports_are_registered_without(names):
    run = subprocess.run([sys.executable, "-c", HIDDEN.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    queries, sql = (set(line.split()) for line in run.stdout.splitlines())
    assert set(REPORT_QUERIES) | set(OPERATOR_QUERIES) == queries == sql


def test_rows_that_documents_are_made_of_are_spread(spark):
    from fixtures.warehouse import warehouse

    tables = warehouse(spark, "/root/testdata/sf0.001")
    for relation, table in (("item", "part"), ("instance", "customer")):
        plain = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        assert plain.rdd.getNumPartitions() == 1  # a single row group
        assert tables[relation].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert sorted(map(repr, tables[table].collect())) == sorted(map(repr, plain.collect()))
