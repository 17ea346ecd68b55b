"""Intermediate tables in a folder that the driver and all executors share, and components of links.

The folder is the one in ``spark.checkpoint.dir``; where that is not set, a folder in the warehouse, which
is shared as well.  A written table cuts the lineage: a lost executor costs its running tasks only.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Rows that a Python worker is sent at once, at most: a batch of whole texts lies there and in the executor beside what is made of it.
ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return folder.rstrip("/")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Work:
    """The intermediate tables of one computation; ``release`` deletes them and no others."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        self._n = 0

    def stage(self, df: DataFrame) -> DataFrame:
        """The table, written and to be read from there.  Shuffle files of the write go as soon as it is done."""
        self._n += 1
        path = f"{self.path}/{self._n}"
        rows = int(self.spark.conf.get(_BATCH))
        with _setting(self.spark, _CLEANUP, "true"), _setting(self.spark, _BATCH, str(min(rows, ROWS) if rows > 0 else ROWS)):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Deletes a staged table that is no longer needed."""
        for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            self._delete(path)

    def release(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def components(work: Work, links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (columns a and b); the component is its smallest node.

    Alternates two steps until every component is a star: every node ties its larger neighbours to the smallest it
    knows of, then its smaller ones.  Rounds grow with the logarithm of a component's size.  Minima are
    taken before the shuffle, and the joins are plain ones, whose hot nodes adaptive execution splits.
    """
    edges = work.stage(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = _spread(both, smallest).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = _spread(large, smallest)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        new = work.stage(small)
        work.drop(edges)
        edges = new
    # Now every node hangs from its component's smallest.
    return work.stage(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end u of ``edges`` has one edge, to a v that is no larger end itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def _spread(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """Joins each edge with what is known of its node u; the hash gives both sides a shuffle of their own, which can be split."""
    edges, smallest = edges.withColumn("s1", F.xxhash64("u")), smallest.withColumn("s2", F.xxhash64("w"))
    return edges.join(smallest, F.expr("u = w and s1 = s2")).drop("s1", "s2", "w")
