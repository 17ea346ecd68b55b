"""Near copies by fast similarity sketching: banding finds candidates, whole sets decide.

A document's set of word shingles is sketched into ``COORDINATES`` values.  In each round every shingle is
thrown into one bin by a hash of the round, and a bin keeps the smallest value that meets it; a value of an
earlier round is smaller than any of a later one.  A document is done when its bins are full, after one round
or two if it has many shingles.  What is still empty after as many rounds as there are bins is filled in a
last pass, in which every shingle is thrown into every such bin; so every coordinate fills, however small the
set.  Two sketches agree in a coordinate with the chance of the sets' Jaccard similarity, and the number
of coordinates in which they agree is concentrated at least as well as for independent ones.

1. Documents with equal sets are one class; its smallest id stands for it.
2. Banding: classes that agree in all ``ROWS`` coordinates of a band share a bucket.  Two sets as similar as a
   link asks for share none with a chance below 3 in 10 million (``missed``); no bucket is capped.
3. In each bucket all classes are compared with one of them, the first in one of eight orders by band.
   What these links connect is a group; large families of near copies are few groups after that.
4. Classes of different groups in one bucket that are left may be similar to each other.  Of their shingles
   those that one group has alone can be in no link between groups and come first, then those that few
   classes have.  For a link, two sets must have a common shingle among the first ones in that order, so far
   to the front that the rest can still make up the overlap; and sketches of which shingles there is an odd number
   may not differ by more than a link allows.  Only pairs that pass both bounds, which are exact, are compared,
   hence a passage that many documents share makes no pairs.
5. A pair is compared by its sketches first, which lets go of it where a link would be a matter of less than
   one in a billion, and then by the whole sets.  Verified links give the components.

A band that two sets share by chance alone costs a comparison.  Shingles are known by 64-bit hashes.  Sets and
sketches travel by shuffle, those of documents without a candidate not at all; the driver gets a bitmap of
fixed size and the size of the components' tables.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A document with fewer than five words has them all as
its one shingle; one without words or text has none, links with nothing and is its own component.  Ids are
of any type that has an order.  Rows that share an id are one document: they are linked, whatever their texts
(those without words apart).  Rows without an id link with nothing, have no component and are kept.  Other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.blocks import Block, blocks, mixed, shingles
from biblioscope.llm.decontam import BITS
from biblioscope.llm.decontam import _bitmap as bitmap
from biblioscope.llm.shared import Work, components

SIZE, PERCENT = 5, 85
COORDINATES, ROWS = 192, 6
BANDS = COORDINATES // ROWS
#: Orders in which the first class of a bucket is looked for: a bucket's band chooses one.
LEADERS = 8
#: Longs of the sketch that bounds a pair's difference.
ODD = 8
#: Chance that a pair which links is let go of by its sketches, at most.
LOST = 1e-9

_AT_ONCE = 4 << 20
_DOCS = 2048
_ROUNDS = np.random.default_rng(20250301).integers(1, 2**64, 2 * COORDINATES, dtype=np.uint64) | np.uint64(1)
_EMPTY = np.uint64(2**64 - 1)
_LOW = np.uint64(0xFFFFFFFF)


def missed(percent: int = PERCENT) -> float:
    """Chance that two sets of this similarity share no band."""
    return (1 - (percent / 100) ** ROWS) ** BANDS


def agreement(percent: int = PERCENT, lost: float = LOST) -> int:
    """Coordinates in which sketches of sets that similar agree but for a chance of ``lost``, by Chernoff's bound."""
    p = percent / 100
    for k in range(int(p * COORDINATES), 0, -1):
        q = k / COORDINATES
        if exp(-COORDINATES * (q * log(q / p) + (1 - q) * log((1 - q) / (1 - p)))) <= lost:
            return k
    return 0


def sets(block: Block) -> list[np.ndarray]:
    """The distinct shingles of each document, sorted by hash."""
    starts, ends, first = block.words()
    found, begins = shingles(block.hashes(starts, ends), first, SIZE)
    return [np.unique(found[begins[i] : begins[i + 1]]) for i in range(block.n)]


def _print_of(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that are equal for equal sets."""
    return tuple(int(x.view(np.int64)) for x in (s.sum(dtype=np.uint64), mixed(s ^ _ROUNDS[0]).sum(dtype=np.uint64)))


def _thrown(tokens: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the value of each shingle in round ``r``."""
    h = mixed(tokens * _ROUNDS[r])
    bins = ((h >> np.uint64(32)) * np.uint64(COORDINATES)) >> np.uint64(32)
    return bins.astype(np.int64), (np.uint64(r) << np.uint64(32)) | (h & _LOW)


def sketched(found: list[np.ndarray]) -> np.ndarray:
    """A row of ``COORDINATES`` values for each set; that of an empty set stays empty."""
    sizes = np.array([len(s) for s in found], dtype=np.int64)
    values = np.full((len(found), COORDINATES), _EMPTY, dtype=np.uint64)
    flat = values.reshape(-1)
    tokens = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
    of = np.repeat(np.arange(len(found)), sizes)
    for r in range(COORDINATES):
        bins, thrown = _thrown(tokens, r)
        np.minimum.at(flat, of * COORDINATES + bins, thrown)
        unfilled = (values == _EMPTY).any(axis=1) if r else (values == _EMPTY).any(axis=1) & (sizes > 0)
        left = unfilled[of]
        if not left.any():
            return values
        tokens, of = tokens[left], of[left]
    docs, bins = np.nonzero((values == _EMPTY) & (sizes > 0)[:, None])
    if len(docs):
        per = sizes[docs]
        begins = np.concatenate([[0], np.cumsum(per)[:-1]])
        start = np.searchsorted(of, docs)  # the shingles of documents with empty bins are all there
        at = np.repeat(start - begins, per) + np.arange(per.sum())
        round_ = np.repeat(bins + COORDINATES, per)
        h = mixed(tokens[at] * _ROUNDS[round_])
        values[docs, bins] = np.minimum.reduceat((round_.astype(np.uint64) << np.uint64(32)) | (h & _LOW), begins)
    return values


def odd(tokens: np.ndarray) -> np.ndarray:
    """Which of 64 * ``ODD`` bins hold an odd number of a set's shingles, as bits: two such sketches differ in no more bins than the sets in shingles."""
    bins = (mixed(tokens ^ _ROUNDS[1]) >> np.uint64(64 - (64 * ODD).bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(bins, minlength=64 * ODD) & 1).astype(np.uint8)).view(np.int64)


def bands(values: np.ndarray) -> np.ndarray:
    """The keys of each sketch's buckets."""
    out = np.zeros((len(values), BANDS), dtype=np.uint64)
    for k in range(ROWS):
        out = mixed((out ^ values[:, k::ROWS]) * _ROUNDS[k + 1])
    return mixed(out + np.arange(BANDS, dtype=np.uint64))


_LONG = pa.int64()
_FEATURES = ["doc_id", "n", "f1", "f2", "bands", "sketch"]


def features(documents: DataFrame, kind: str) -> DataFrame:
    """For each row of ``documents`` (doc_id, text): the size and print of its set, its buckets, and a byte of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", lower=True, limit=_AT_ONCE):
                found = sets(block)
                for a in range(0, block.n, _DOCS):
                    own = found[a : a + _DOCS]
                    values, m = sketched(own), len(own)
                    keys = pa.ListArray.from_arrays(np.arange(0, BANDS * m + 1, BANDS, dtype=np.int32), bands(values).view(np.int64).reshape(-1))
                    bytes_ = mixed(values).astype(np.uint8).reshape(-1)
                    sketch = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(np.arange(0, COORDINATES * m + 1, COORDINATES, dtype=np.int32)), pa.py_buffer(bytes_)])
                    prints = [_print_of(s) for s in own]
                    counts = [pa.array(x, _LONG) for x in ([len(s) for s in own], [p[0] for p in prints], [p[1] for p in prints])]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.rows.start + a, m), *counts, keys, sketch], names=_FEATURES)

    return documents.mapInArrow(run, f"doc_id {kind}, n long, f1 long, f2 long, bands array<long>, sketch binary")


def shingled(documents: DataFrame, nodes: DataFrame, kind: str, bits: int = BITS) -> DataFrame:
    """(node, f1, n, tokens, odd) of the classes ``nodes`` (node, f1, f2).

    A bitmap of the nodes' hashes, of a fixed size, lets go of most other documents where they lie.
    """
    flags = np.packbits(bitmap(nodes.select(F.xxhash64("node").alias("token")).distinct(), bits))
    sent, shift = documents.sparkSession.sparkContext.broadcast(flags), np.uint64(64 - bits.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe, seen = np.unpackbits(sent.value).astype(bool), set()
        for batch in batches:
            batch = batch.filter(pa.array(maybe[batch.column(2).to_numpy().view(np.uint64) >> shift]))
            for block in blocks(batch, "text", lower=True, limit=_AT_ONCE):
                rows, found, prints = [], [], []
                ids = batch.column(2).to_numpy()
                for i, s in enumerate(sets(block), block.rows.start):
                    own = _print_of(s)
                    if len(s) and (ids[i], *own) not in seen:
                        seen.add((ids[i], *own))  # rows that repeat
                        rows.append(i)
                        found.append(s.view(np.int64))
                        prints.append(own)
                odds = pa.array([odd(s.view(np.uint64)) for s in found], pa.list_(_LONG))
                columns = [batch.column(0).take(pa.array(rows, _LONG)), *[pa.array([p[k] for p in prints], _LONG) for k in (0, 1)], pa.array(found, pa.list_(_LONG)), odds]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "f1", "f2", "tokens", "odd"])

    made = documents.where("doc_id is not null").withColumn("h", F.xxhash64("doc_id")).mapInArrow(run, f"node {kind}, f1 long, f2 long, tokens array<long>, odd array<long>")
    return made.join(nodes, ["node", "f1", "f2"]).select("node", "f1", F.size("tokens").alias("n"), "tokens", "odd")


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """A hash of the keys, by which a side of a join has a shuffle of its own that can be split."""
    return rows.withColumn("spread", F.xxhash64(*keys))


def _both(pairs: DataFrame, of_node: DataFrame, value: str) -> DataFrame:
    """``pairs`` (a, b) with the value of both ends, brought by one join after the other."""
    for end in "ab":
        side = of_node.select(F.col("node").alias(end), F.col(value).alias(f"{value}_{end}"))
        pairs = _spread(pairs, end).join(_spread(side, end), [end, "spread"]).drop("spread")
    return pairs


class _Near:
    """One search: the classes' sketches and sets, and the links found so far."""

    def __init__(self, work: Work, documents: DataFrame, kind: str, percent: int):
        self.work, self.percent, self.kind = work, percent, kind
        self.rows = work.stage(features(documents, kind))
        there = self.rows.where("n > 0 and doc_id is not null")
        self.classes = work.stage(there.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
        # Ids of rows with different sets: their classes are linked.
        split = there.groupBy("doc_id").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).where("lo != hi").select("doc_id")
        several = there.select("doc_id", "n", "f1", "f2").join(split, "doc_id").join(self.classes.select("n", "f1", "f2", "node"), ["n", "f1", "f2"])
        self.links = work.stage(several.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a != b").distinct())

        banded = self.classes.select("node", "n", F.posexplode("bands").alias("band", "key"))
        repeated = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
        self.live = work.stage(_spread(banded, "key").join(_spread(repeated, "key"), ["key", "spread"]).drop("spread"))
        nodes = self.live.select("node").distinct()
        live_classes = self.classes.join(nodes, "node", "left_semi")
        self.sketches = work.stage(live_classes.select("node", "sketch"))
        self.tokens = work.stage(shingled(documents, live_classes.select("node", "f1", "f2"), kind))

    def close(self, n: F.Column, m: F.Column) -> F.Column:
        """Sets of these sizes may link."""
        return 100 * F.least(n, m) >= self.percent * F.greatest(n, m)

    def compare(self, pairs: DataFrame) -> None:
        """Adds the links among ``pairs`` (a, b)."""
        least = agreement(self.percent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES) for k in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= least))

        pairs = self.work.stage(_both(pairs.distinct(), self.sketches, "sketch").mapInArrow(run, f"a {self.kind}, b {self.kind}"))
        overlap, n, m = F.size(F.array_intersect("tokens_a", "tokens_b")), F.size("tokens_a"), F.size("tokens_b")
        links = _both(pairs, self.tokens, "tokens").where(100 * overlap >= self.percent * (n + m - overlap))
        self.links = self.work.stage(self.links.union(links.select("a", "b")))

    def components(self) -> DataFrame:
        """(node, grp): the component of each node that has a link."""
        return components(self.work, self.links).withColumnRenamed("component", "grp")

    def between(self, groups: DataFrame) -> DataFrame:
        """The rows of buckets in which more than one group is left, each with its group.  Groups save work and decide nothing."""
        rows = _spread(self.live, "node").join(_spread(groups, "node"), ["node", "spread"], "left").drop("spread")
        rows = rows.withColumn("grp", F.coalesce("grp", "node"))
        several = rows.groupBy("key").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo < hi").select("key")
        return self.work.stage(_spread(rows, "key").join(_spread(several, "key"), ["key", "spread"]).drop("spread"))

    def against_first(self) -> None:
        """Compares the classes of each bucket with the first of them."""
        order = F.xxhash64("node", F.col("band") % LEADERS)
        first = self.live.groupBy("key").agg(F.min(F.struct(order.alias("h"), "node", "n")).alias("first"))
        rows = _spread(self.live, "key").join(_spread(first, "key"), ["key", "spread"]).where(F.col("node") != F.col("first.node"))
        self.compare(rows.where(self.close(F.col("n"), F.col("first.n"))).select(F.col("node").alias("a"), F.col("first.node").alias("b")))

    def by_first_shingles(self, rows: DataFrame) -> None:
        """Compares classes of different groups whose first shingles, rare ones first, leave room for a link."""
        t = self.percent
        nodes = rows.select("node", "grp").distinct()
        each = self.work.stage(_spread(self.tokens, "node").join(_spread(nodes, "node"), ["node", "spread"]).drop("spread"))
        tokens = each.select("node", "f1", "n", "grp", F.explode("tokens").alias("token"))
        counted = tokens.groupBy("token").agg(F.count("*").alias("often"), F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.min("n").alias("smallest"))
        counted = self.work.stage(counted.where("lo < hi").select("token", "often", "smallest"))
        shared = _spread(tokens, "token").join(_spread(counted, "token"), ["token", "spread"])
        shared = shared.groupBy("node", "f1", "n", "grp").agg(F.sort_array(F.collect_list(F.struct("often", "token", "smallest"))).alias("shared"))
        places = shared.select("node", "f1", "n", "grp", (F.col("n") - F.size("shared")).alias("alone"), "shared", F.posexplode("shared").alias("k", "x"))
        places = places.withColumn("before", F.when(F.col("k") > 0, F.expr("shared[k - 1].token")))
        places = places.select("node", "f1", "n", "grp", (F.col("alone") + F.col("k")).alias("place"), "x.token", "x.smallest", "before")
        # What is left from a place on is the largest overlap of a pair whose first common shingle is there.
        room = F.col("n") - F.col("place")
        enough = (100 * room >= t * F.col("n")) & ((100 + t) * room >= t * (F.col("n") + F.col("smallest")))
        odds = _spread(each.select("node", "f1", "odd"), "node")
        places = self.work.stage(_spread(places.where(enough).drop("smallest"), "node").join(odds, ["node", "f1", "spread"]).drop("spread", "f1"))
        one, two = (places.select("token", F.xxhash64("token").alias("spread"), *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "grp", "place", "before", "odd")]) for x in "ab")
        met = one.join(two, ["token", "spread"]).where("grp_a < grp_b").where(self.close(F.col("n_a"), F.col("n_b")))
        n, room = F.col("n_a") + F.col("n_b"), F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
        met = met.where((100 + t) * room >= t * n)
        # A pair that has the shingle in front in common as well meets there.
        met = met.where(F.col("before_a").isNull() | F.col("before_b").isNull() | (F.col("before_a") != F.col("before_b")))
        differ = sum((F.bit_count(F.col("odd_a")[k].bitwiseXOR(F.col("odd_b")[k])) for k in range(1, ODD)), F.bit_count(F.col("odd_a")[0].bitwiseXOR(F.col("odd_b")[0])))
        met = met.where((100 + t) * differ <= (100 - t) * n)
        self.compare(met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))


def near_copies(work: Work, documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept), a row for each row of ``documents``; of each component the smallest id is kept."""
    documents = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    near = _Near(work, documents, dict(documents.dtypes)["doc_id"], percent)
    near.against_first()
    near.by_first_shingles(near.between(near.components()))
    final = components(work, near.links)
    of_class = near.classes.join(final, "node", "left").select("n", "f1", "f2", F.coalesce("component", "node").alias("component"))
    # A hot class may have a large share of the rows: its hash lets both sides be shuffled for this join alone.
    left, right = (_spread(x, "f1", "f2") for x in (near.rows.select("doc_id", "n", "f1", "f2"), of_class))
    out = left.join(right, ["n", "f1", "f2", "spread"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))
