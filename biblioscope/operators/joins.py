"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter by ``likely``: half a megabyte, whatever the number of keys.
FILTER_BITS = 1 << 22


def spread_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Many-to-one join in which Spark can always split a hot key of ``many``.

    Adaptive execution splits a hot partition only where both sides are shuffled for this very
    join.  A side that an earlier join or aggregation left partitioned by ``key`` would skip its
    shuffle, so the key's hash joins the condition and gives each side a shuffle of its own.
    """
    many, one = (side.withColumn("_spread", F.xxhash64(key)) for side in (many, one))
    return many.join(one, [key, "_spread"], how).drop("_spread")


def only(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``, which may repeat.

    An inner join with the distinct keys: Spark moves a semi join below the columns that are parsed from a
    document, and would shuffle the documents then.
    """
    return spread_join(df, keys.select(key).distinct(), key)


def likely(df: DataFrame, key: str, keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``column`` of ``keys``, for a join with these that comes after.

    A hash of each key sets one of ``bits`` bits, a scalar subquery of fixed size that the rows are tested by where they
    lie: what the join would drop is neither parsed nor shuffled.  No row the join keeps is lost; with more keys than
    bits the filter lets most rows through.
    """

    def hashed(value: str) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(bits))

    def word(value: Column) -> Column:
        return F.shiftright(value, 6).cast("int").alias("word")

    def bit(value: Column) -> Column:
        return value.bitwiseAND(F.lit(63)).cast("int")

    one = hashed(column)
    found = keys.select(word(one), F.call_function("shiftleft", F.lit(1).cast("long"), bit(one)).alias("set"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("set"))
    words = found.unionByName(every).groupBy("word").agg(F.bit_or("set").alias("set"))
    words = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda w: w["set"])).scalar()
    asked = hashed(key)
    return df.where(F.getbit(F.get(words, word(asked)), bit(asked)) == 1)


def bounds(df: DataFrame, low: Column, high: Column) -> tuple[Column, Column]:
    """The least ``low`` and the greatest ``high`` as scalar subqueries that a scan takes as bounds; NULL without rows.

    The second is a top row and not an aggregate: Spark would merge two aggregates of one input into a struct, and
    pushes no field of that down.
    """
    greatest = df.select(high.alias("high")).orderBy(F.desc_nulls_last("high")).limit(1)
    return df.agg(F.min(low)).scalar(), greatest.scalar()
