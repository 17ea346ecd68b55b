"""Output contracts and PostgreSQL-style ordering."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Rename by position and cast to the declared column types."""
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if len(df.columns) != len(declared.fields):
        raise ValueError(f"{len(df.columns)} columns where {len(declared.fields)} are declared")
    renamed = df.toDF(*declared.names)
    return renamed.select(*[_as_declared(renamed, f).alias(f.name) for f in declared.fields])


def _as_declared(df: DataFrame, field: T.StructField) -> Column:
    column, kind = F.col(field.name), df.schema[field.name].dataType
    if isinstance(kind, T.TimestampNTZType) and isinstance(field.dataType, T.TimestampType):
        # A UTC wall clock becomes the instant it stands for, whatever the session's zone.
        column = F.convert_timezone(F.lit("UTC"), F.current_timezone(), column)
    if isinstance(kind, T.TimestampType) and isinstance(field.dataType, T.TimestampNTZType):
        column = F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz"))
    return column.cast(field.dataType)


_collation: ContextVar[str | None] = ContextVar("collation", default=None)


@contextmanager
def collated(name: str | None) -> Iterator[None]:
    """Texts are sorted by this collation of Spark's in the block; None sorts them by their bytes."""
    token = _collation.set(name)
    try:
        yield
    finally:
        _collation.reset(token)


def sorted_by(df: DataFrame, *keys: str) -> DataFrame:
    """Total order with the database's NULL placement: last ascending, first descending.

    ``-name`` sorts descending.  Pass enough keys to tell rows apart, so that a value shared
    by very many rows can still be split over several range partitions.  Texts go by the collation that
    ``collated`` sets, those it holds for equal by their bytes, after all keys.
    """
    collation = _collation.get()
    names = [k.removeprefix("-") for k in keys]
    texts = {name for name in names if collation and isinstance(df.schema[name].dataType, T.StringType)}

    def key(name: str) -> Column:
        return F.collate(F.col(name), collation) if name in texts else F.col(name)

    order = [F.desc_nulls_first(key(n)) if k.startswith("-") else F.asc_nulls_last(key(n)) for k, n in zip(keys, names, strict=True)]
    order += [F.desc_nulls_first(n) if k.startswith("-") else F.asc_nulls_last(n) for k, n in zip(keys, names, strict=True) if n in texts]
    return df.orderBy(*order)
