"""The test relations as Spark frames and as WITH clauses of the SQL oracle."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from biblioscope import Tables
from fixtures.dialects import DuckDB, Spark
from fixtures.relations import ON_SPARK, RELATIONS, SOURCES


def _read_by(text: str) -> list[str]:
    """Names in braces, in order of first use."""
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(text) if name))


#: Small files of which large documents are made: their rows are spread, as a task would else make those of a whole row group.
SPREAD = {"part": "p_partkey", "customer": "c_custkey"}


def warehouse(spark: SparkSession, sf_dir: str) -> Tables:
    """Relations derived by Spark from the tables in ``sf_dir``."""

    def find(name: str) -> DataFrame | None:
        if name in SOURCES:
            source = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            return source.repartition(2 * spark.sparkContext.defaultParallelism, SPREAD[name]) if name in SPREAD else source
        if name not in RELATIONS:
            return None
        text = ON_SPARK.get(name, RELATIONS[name])(Spark())
        return spark.sql(text, **{source: tables[source] for source in _read_by(text)})

    tables = Tables(spark, find)
    return tables


def oracle(query: str) -> str:
    """``query`` for DuckDB, its relations in braces put in front as common table expressions."""
    clauses: dict[str, str] = {}

    def add(name: str) -> None:
        if name in SOURCES or name in clauses:
            return
        text = RELATIONS[name](DuckDB())
        for source in _read_by(text):
            add(source)
        clauses[name] = _plain(text)

    for name in _read_by(query):
        add(name)
    heads = ", ".join(f"{name} as ({text})" for name, text in clauses.items())
    own = _plain(query).strip()
    if not heads:
        return own
    return f"with {heads}, {own[5:]}" if own.startswith("with ") else f"with {heads} {own}"


def _plain(text: str) -> str:
    return text.format(**{name: name for name in _read_by(text)})


def land(tables: Tables, root: str, files: int = 8) -> Tables:
    """Write every relation as Parquet below ``root``, as a warehouse would hold it, and read from there."""
    for name in RELATIONS:
        if name != "reserve_versions":
            tables[name].repartition(files).write.parquet(f"{root}/{name}")
    return Tables.parquet(tables.spark, root)
