"""Resolver from logical relation names to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from biblioscope.operators.history import current_rows, rows_at


class Tables:
    """Lazy, memoised relations by name.

    Naming follows the warehouse: ``X`` current raw table with a ``jsonb`` document, ``X__`` its
    history, ``X__t`` current flattened table, ``X__t__`` flattened history, and plain names for
    derived tables.  A current table that is not provided is taken from its history.
    """

    def __init__(self, spark: SparkSession, find: Callable[[str], DataFrame | None], buckets: Callable[[str], list[str]] | None = None):
        self.spark = spark
        self._find = find
        self._buckets = buckets or (lambda name: [])
        self._known: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(spark, frames.get)

    @classmethod
    def parquet(cls, spark: SparkSession, locations: Mapping[str, str] | str) -> Tables:
        """Parquet directories: a mapping of names to paths, or one root holding ``<name>/``."""
        if isinstance(locations, str):
            root = spark._jvm.org.apache.hadoop.fs.Path(locations)
            fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
            locations = {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(root)}
        found = dict(locations)
        return cls(spark, lambda name: spark.read.parquet(found[name]) if name in found else None)

    @classmethod
    def catalog(cls, spark: SparkSession, names: Mapping[str, str] | str) -> Tables:
        """Catalog tables: a mapping of names to qualified tables, or one schema holding all."""

        def find(name: str) -> DataFrame | None:
            table = qualified(name)
            return spark.table(table) if table and spark.catalog.tableExists(table) else None

        def qualified(name: str) -> str | None:
            return names.get(name) if not isinstance(names, str) else f"{names}.{name}"

        def buckets(name: str) -> list[str]:
            table = qualified(name)
            there = table and spark.catalog.tableExists(table)
            return [column.name for column in spark.catalog.listColumns(table) if column.isBucket] if there else []

        return cls(spark, find, buckets)

    def having(self, frames: Mapping[str, DataFrame], clustered: Mapping[str, list[str]] | None = None) -> Tables:
        """The same relations with some added or replaced; ``clustered`` tells which of these are stored by a key."""
        own = clustered or {}
        return Tables(
            self.spark,
            lambda name: frames[name] if name in frames else self._given(name),
            lambda name: own.get(name, []) if name in frames else self._buckets(name),
        )

    def without(self, *names: str) -> Tables:
        """The same relations but these."""
        return Tables(self.spark, lambda name: None if name in names else self._given(name), self._buckets)

    def clustered(self, name: str) -> list[str]:
        """The columns by which a relation, or the history it is taken from, is stored in buckets; none if it is not."""
        history = not name.endswith("__") and self._given(name) is None
        return self._buckets(name + "__" if history else name)

    def as_of(self, instant: str) -> Tables:
        """The same relations as they were at an instant (UTC): current tables are taken from their histories, where these have spans."""

        def find(name: str) -> DataFrame | None:
            history = None if name.endswith("__") else self._given(name + "__")
            dated = history is not None and {"__start", "__end"} <= set(history.columns)
            return rows_at(history, instant) if dated else self._given(name)

        return Tables(self.spark, find)

    def _given(self, name: str) -> DataFrame | None:
        if name not in self._known:
            frame = self._find(name)
            if frame is None:
                return None
            self._known[name] = frame
        return self._known[name]

    def get(self, name: str) -> DataFrame | None:
        frame = self._given(name)
        if frame is None and not name.endswith("__"):
            history = self._given(name + "__")
            frame = None if history is None else current_rows(history)
        return frame

    def __getitem__(self, name: str) -> DataFrame:
        frame = self.get(name)
        if frame is None:
            raise KeyError(f"relation {name!r} is not provided")
        return frame
