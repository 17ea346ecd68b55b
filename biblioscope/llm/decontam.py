"""Benchmark items inside documents: MinHash containment search by size of item, verified exactly.

An item is found in a document that has ``PERCENT`` percent or more of the item's distinct word shingles,
wherever they stand.  Long documents have a Jaccard similarity of nearly nought with a short item, so the
search asks for containment: an item's bottom-k MinHash is a sample of its shingles, and the chance that a
document has one of them is the containment itself.  Items are partitioned by size, and a partition's k is
such that nothing is missed: a document that has 75 % of n shingles has one of any n - ceil(0.75 n) + 1.

Documents are read once against two bitmaps of ``BITS`` bits, one of the sampled shingles and one of all
shingles of the items.  The bitmaps have that size however large the benchmark is; if many items fill them,
more shingles pass, none is lost.  Of documents that have a sampled shingle, the shingles that an item may
have are joined with the items' and counted.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; an item with fewer than five words is one shingle of all
its words and found wherever these stand in a row.  Items without words are found nowhere.  Null texts
count as empty.  Rows that share an id (null is an id) are one document or item, except that ``clean`` decides
rows without an id one by one.  Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from biblioscope.llm.blocks import blocks, shingles
from biblioscope.llm.shared import Work

SIZE, PERCENT = 5, 75
BITS = 1 << 23

def items_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, size, token, n, sampled): each distinct shingle of each item, n the number of them."""
    kind = dict(benchmark.dtypes)[item]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", lower=True):
                starts, ends, first = block.words()
                found, begins = shingles(block.hashes(starts, ends), first, SIZE)
                size = np.minimum(np.diff(first), SIZE)
                ids = batch.column(0).slice(block.rows.start, block.n)
                per = np.diff(begins)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(block.n), per))), pa.array(np.repeat(size, per).astype(np.int32)), pa.array(found.view(np.int64))], names=["item_id", "size", "token"])

    rows = benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("text")).mapInArrow(run, f"item_id {kind}, size int, token long").distinct()
    sizes = rows.groupBy("item_id").agg(F.count("*").alias("n")).select(F.col("item_id").alias("_id"), "n")
    rows = rows.join(sizes, F.col("item_id").eqNullSafe(F.col("_id"))).drop("_id")
    # Hashes are mixed, so their order is a random one.  Items of one size have samples of one length.
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("token"))
    return rows.withColumn("sampled", rank <= F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1)


def _bitmap(tokens: DataFrame, bits: int) -> np.ndarray:
    """``bits`` flags, of which those of the tokens are set: what comes to the driver has a fixed size."""
    shift = 64 - bits.bit_length() + 1
    position = F.shiftrightunsigned("token", shift)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63)).cast("int"))
    words = tokens.groupBy(F.shiftright(position, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    flags = np.zeros(bits // 64, dtype=np.uint64)
    for row in words.toLocalIterator():
        flags[row["word"]] = np.uint64(row["bits"] & (2**64 - 1))
    return np.unpackbits(flags.view(np.uint8), bitorder="little").astype(bool)


def contaminated(work: Work, documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", bits: int = BITS) -> DataFrame:
    """(key, item_id, n_item_shingles, n_shared, containment) of each document and item in it.  ``bits`` is a power of two, 64 at least."""
    items = work.stage(items_of(benchmark, item, text))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # five at most
    flags = work.spark.sparkContext.broadcast((np.packbits(_bitmap(items.where("sampled"), bits)), np.packbits(_bitmap(items, bits))))
    kind = dict(documents.dtypes)[key]
    shift = np.uint64(64 - bits.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampled, listed = (np.unpackbits(x).astype(bool) for x in flags.value)
        for batch in batches:
            for block in blocks(batch, "text", lower=True):
                starts, ends, first = block.words()
                words = block.hashes(starts, ends)
                tokens, docs = [], []
                for size in sizes:
                    found, begins = shingles(words, first, size)
                    at = np.flatnonzero(listed[found >> shift])
                    tokens.append(found[at])
                    docs.append(np.searchsorted(begins, at, "right") - 1)
                if not tokens:
                    continue
                token, doc = np.concatenate(tokens), np.concatenate(docs)
                hit = np.zeros(block.n, dtype=bool)
                hit[doc[sampled[token >> shift]]] = True
                token, doc = token[hit[doc]], doc[hit[doc]]
                ids = batch.column(0).slice(block.rows.start, block.n)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array(token.view(np.int64))], names=["id", "token"])

    if not sizes:
        return items.select(F.lit(None).cast(kind).alias(key), "item_id", F.col("n").alias("n_item_shingles"), F.col("n").alias("n_shared"), F.lit(0.0).alias("containment")).where("false")
    found = documents.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, token long")
    # A passage that many documents have makes its shingles hot; the hash lets the join be split there.
    found, listed = found.withColumn("s", F.xxhash64("token")), items.select("token", "item_id", "n").withColumn("s", F.xxhash64("token"))
    shared = found.join(listed, ["token", "s"]).groupBy("id", "item_id", "n", "token").agg(F.lit(1).alias("once"))
    counted = shared.groupBy("id", "item_id", "n").agg(F.count("*").alias("n_shared"))
    return counted.where(100 * F.col("n_shared") >= PERCENT * F.col("n")).select(
        F.col("id").alias(key), "item_id", F.col("n").alias("n_item_shingles"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment")
    )


def clean(work: Work, documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no item is found, with their columns as they were.  Rows without an id are known by their text."""
    by_text = F.when(F.col(key).isNull(), F.sha2(F.col(text).cast("binary"), 256))
    keyed = documents.select(F.struct(F.col(key).alias("id"), by_text.alias("text")).alias("_key"), F.col(text))
    found = contaminated(work, keyed, benchmark, "_key", text).select(F.col("_key.id").alias("_bad"), F.col("_key.text").alias("_bad_text"))
    bad = work.stage(found.distinct())
    return documents.join(bad, F.col(key).eqNullSafe(F.col("_bad")) & by_text.eqNullSafe(F.col("_bad_text")), "left_anti")
