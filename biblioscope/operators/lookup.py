"""Resolving ids through code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_name(df: DataFrame, codes: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name``: the code table's name for the id in ``key``, NULL where there is none.

    No broadcast hint: Spark broadcasts the table when its size allows and shuffles otherwise.
    A table used in several roles is broadcast once, as all roles read the same two columns.
    """
    names = codes.select(F.col("id").alias("_code"), F.col("name").alias(name))
    return df.join(names, F.col(key) == F.col("_code"), "left").drop("_code")
