"""Token counts by source, language and tokenizer version, kept by adding what changes.

A batch is a table of signed changes: +1 for a document that comes, -1 for one that goes, and both, with the
old and the new count, for one whose count is revised.  Committing a batch adds up its changes by group and
writes the sums as the folder ``batch=<id>`` of the rollup; totals are the sums over all batches, so they are
exact in whatever order batches arrive.  A batch that is there is not added again, and one that broke off is
not there: Spark's commit makes the folder's _SUCCESS the last thing written, and a folder without one is
replaced.  ``compact`` turns many batches into one that remembers their ids.

Null sources and languages are groups of their own.  A null text has no tokens and counts as a document.
Repeated rows in a batch count as often as they are there.  An empty batch is committed and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioscope.llm.blocks import blocks, column, spans
from biblioscope.llm.bpe import AT_ONCE, Tokenizer
from biblioscope.llm.decontam import BITS
from biblioscope.llm.decontam import _bitmap as bitmap

GROUP = ("source", "lang", "tokenizer")
_CHANGES = "source string, lang string, tokenizer string, docs long, tokens long"


def counted(df: DataFrame, versions: dict[str, Tokenizer | None], text: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens): a row for each document and tokenizer version; None counts words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.select(["doc_id", "source", "lang"]).columns
            for version, tokenizer in versions.items():
                if tokenizer is None:
                    counts = [np.diff(block.words()[2]) for block in blocks(batch, text)]
                else:
                    data, at = column(batch, text)
                    counts = [np.diff(tokenizer.encoder().encode(data[at[a] : at[b]], at[a : b + 1] - at[a])[1]) for a, b in spans(at, AT_ONCE)]
                n = pa.array(np.concatenate(counts) if counts else [], pa.int64())
                yield pa.RecordBatch.from_arrays([*others, pa.array([version] * batch.num_rows, pa.string()), n], names=["doc_id", "source", "lang", "tokenizer", "tokens"])

    kind = dict(df.dtypes)["doc_id"]
    return df.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), text).mapInArrow(run, f"doc_id {kind}, source string, lang string, tokenizer string, tokens long")


def among(df: DataFrame, keys: DataFrame, key: str = "doc_id", bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys``; null keys are in none.

    A bitmap of the keys' hashes, of a fixed size, lets go of most other rows where they lie, so that the
    join that decides shuffles few texts.  If very many keys fill it, it only saves less.
    """
    hashed = F.xxhash64(key)
    flags = np.packbits(bitmap(keys.where(F.col(key).isNotNull()).select(hashed.alias("token")), bits))
    sent, shift, schema = df.sparkSession.sparkContext.broadcast(flags), np.uint64(64 - bits.bit_length() + 1), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            last = batch.num_columns - 1
            kept = maybe[batch.column(last).to_numpy().view(np.uint64) >> shift]
            yield pa.RecordBatch.from_arrays(batch.columns[:last], names=schema.names).filter(pa.array(kept))

    few = df.withColumn("_hash", hashed).mapInArrow(run, schema)
    return few.join(keys.select(key).distinct(), key, "left_semi")


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Changes from counts: documents that come (1) or go (-1)."""
    return counts.select(*GROUP, F.lit(sign).cast("long").alias("docs"), (sign * F.col("tokens")).cast("long").alias("tokens"))


class Rollup:
    """The totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _there(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def _listed(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(place):
            return []
        names = sorted(x.getPath().getName() for x in fs.listStatus(place))
        return [x for x in names if x.startswith("batch=") and self._there(f"{self.path}/{x}/_SUCCESS")]

    def batches(self) -> set[str]:
        """The ids of the batches that are in the totals."""
        found = set()
        for x in self._listed():
            inside = x.removeprefix("batch=")
            found |= set(inside.split("+"))
        return found

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch; False if it is there already."""
        if not batch or set(batch) & set("+/="):
            raise ValueError("a batch id has a character and none of + / =")
        if batch in self.batches():
            return False
        sums = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens); groups in which nothing is left are gone."""
        paths = [f"{self.path}/{x}" for x in self._listed()]
        rows = self.spark.read.schema(_CHANGES).parquet(*paths) if paths else self.spark.createDataFrame([], _CHANGES)
        sums = rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 or tokens != 0")

    def compact(self, path: str) -> Rollup:
        """The same totals and batch ids as one batch in another folder."""
        other = Rollup(self.spark, path)
        ids = sorted(self.batches())
        if ids:
            self.totals().write.mode("overwrite").parquet(f"{other.path}/batch={'+'.join(ids)}")
        return other
