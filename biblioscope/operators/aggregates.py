"""Text aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_counts(df: DataFrame, key: str, text: str, into: str) -> DataFrame:
    """Per ``key`` its distinct texts in order, each with the number of times it occurs.

    Repeats are counted before the shuffle, so a key with very many rows sends few.
    """
    counted = df.where(F.col(text).isNotNull()).groupBy(key, text).agg(F.count(F.lit(1)).alias("times"))
    return counted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(text, "times"))).alias(into))


def joined_texts(counts: str, text: str, separator: str, copies: Column | None = None) -> Column:
    """The texts of a ``text_counts`` column as one text, every occurrence ``copies`` times."""
    factor = F.lit(1) if copies is None else copies

    def repeated(counted: Column) -> Column:
        further = (counted.times * factor - 1).cast("int")
        return F.concat(F.repeat(F.concat(counted[text], F.lit(separator)), further), counted[text])

    return F.array_join(F.transform(counts, repeated), separator)
