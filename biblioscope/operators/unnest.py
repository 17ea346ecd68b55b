"""Unnesting of arrays inside JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unnest_json(
    df: DataFrame, document: str, key: str, element: T.DataType, value: str, ordinality: str | None = None
) -> DataFrame:
    """One row per element of the array ``document.key``, numbered from 1 in ``ordinality``.

    Rows whose array is absent, empty or not an array disappear.
    """
    parsed = F.from_json(document, T.StructType([T.StructField(key, T.ArrayType(element))]))[key]
    if ordinality is None:
        return df.select("*", F.explode(parsed).alias(value))
    numbered = df.select("*", F.posexplode(parsed).alias(ordinality, value))
    return numbered.withColumn(ordinality, F.col(ordinality) + 1)
