"""Counting events that fall inside validity spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioscope.sources.staging import kept

#: Spans from which on a key is hot, and the parts its spans are then spread over.
HOT_SPANS = 100_000
HOT_PARTS = 64


def count_in_spans(
    events: DataFrame, spans: DataFrame, on: str, by: list[str], day: str, start: str, end: str, count: str, times: str | None = None,
    hot: int = HOT_SPANS,
) -> DataFrame:
    """Number of (event, span) pairs with equal ``on`` and ``day`` in ``[start, end]``, per ``on`` and ``by``.

    Groups without a pair give no row; a span without a start or an end matches nothing.  A row of ``events`` is
    one event, or as many as its column ``times`` says.

    The pairs are never built.  Events are first reduced to one count per key and day, then met by the days that
    spans ask for in a running total by day; a span holds total(end) - total(start - 1).  So the work is linear in
    events plus spans.  However many events a key has, it puts one row per calendar day in a task; the spans of a key
    with more than ``hot`` are spread over parts, each of which has the days of the key's events to itself.

    Spans are read twice, so they are kept unless the caller has kept them.
    """
    if not spans.is_cached:
        spans = kept(spans.select(on, *by, start, end))
    spans = spans.where(F.col(on).isNotNull() & (F.col(start) <= F.col(end))).select(on, *by, start, end)
    # At most one key for every ``hot`` spans, mostly none: a scalar subquery that both sides read.
    keys = spans.groupBy(on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).agg(F.collect_list(on)).scalar()
    is_hot = F.array_contains(keys, F.col(on))

    def either(parts: Column, one: Column) -> Column:
        return F.when(is_hot, parts).otherwise(one)

    # Each span asks for the running total on two days: end (+) and the day before start (-).
    edge = F.explode(
        F.array(
            F.struct(F.col(end).alias("day"), F.lit(1).alias("sign")),
            F.struct(F.date_sub(start, 1).alias("day"), F.lit(-1).alias("sign")),
        )
    ).alias("edge")
    part = either(F.pmod(F.xxhash64(*by, start, end), F.lit(HOT_PARTS)).cast("int"), F.lit(0))
    edges = spans.select(on, part.alias("_part"), *by, edge)
    edges = edges.select(on, "_part", *by, F.col("edge.day").alias("day"), F.col("edge.sign").alias("sign"), F.lit(0).cast("long").alias("n"))
    counted = events.select(on, F.col(day).alias("day"), (F.lit(1) if times is None else F.col(times)).cast("long").alias("n"))
    daily = counted.groupBy(on, "day").agg(F.sum("n").alias("n"))
    parts = F.explode(either(F.sequence(F.lit(0), F.lit(HOT_PARTS - 1)), F.array(F.lit(0)))).alias("_part")
    nothing = [F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in by]
    daily = daily.select(on, parts, *nothing, "day", F.lit(None).cast("int").alias("sign"), "n")
    # Of one day the events come first.
    so_far = Window.partitionBy(on, "_part").orderBy("day", F.asc_nulls_first("sign")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.unionByName(edges)
        .withColumn("total", F.sum("n").over(so_far))
        .where(F.col("sign").isNotNull())
        .groupBy(on, *by)
        .agg(F.sum(F.col("sign") * F.col("total")).alias(count))
        .where(F.col(count) > 0)
    )
