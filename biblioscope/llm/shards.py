"""Token ids in training order: fixed-stride binary shards that are read from front to back.

Every document's ids are a sequence with a global slot.  Its index is its place in the input: the rows of
the files before its own, in order of path, and its row number in the file, so nothing is sorted.  The
slot is a keyed permutation of the index: Feistel rounds over the next even power of two, walked on until
they come out below the number of documents.  A shard holds a range of slots; the shuffle sends each
document to its shard's task, which encodes the texts in slot order, ends each with the end id, and writes the
stream of ids as rows of ``stride`` ids, the last row filled up with end ids.  So shard k, row r begins at byte
r * stride * width, and a reader resumes from those two numbers.

A shard is written under a name of its own and moved into place when it is whole, so a lost executor or a
second attempt leaves no half shard; a second attempt writes the same bytes.  ``write`` returns the index of
documents.  Paths go through Arrow's file systems (file, s3, gs, hdfs).

Null and empty texts are sequences of the end id alone.  Repeated rows are sequences each.  An empty table
gives no shard and an empty index.  Columns other than key and text take no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.blocks import column, mixed, spans
from biblioscope.llm.bpe import AT_ONCE, Tokenizer

#: Documents in a shard.
PER_SHARD = 8_192

_ROUNDS = 6


@dataclass(frozen=True)
class Order:
    """A keyed permutation of 0 .. n - 1."""

    n: int
    key: bytes

    def _rounds(self) -> list[np.uint64]:
        return [np.uint64(int.from_bytes(hashlib.blake2b(b"%d" % i, key=self.key, digest_size=8).digest(), "big")) for i in range(_ROUNDS)]

    def _half(self) -> np.uint64:
        return np.uint64(max(1, ((self.n - 1).bit_length() + 1) // 2))

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, False)

    def indexes(self, slot: np.ndarray) -> np.ndarray:
        """The inverse."""
        return self._walk(slot, True)

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        out = values.astype(np.uint64)
        on = np.arange(len(out))
        while len(on):
            out[on] = self._once(out[on], back)
            on = on[out[on] >= np.uint64(self.n)]
        return out.astype(np.int64)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = self._half()
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        keys = self._rounds()
        if back:
            for key in reversed(keys):
                left, right = right ^ (mixed(left ^ key) & mask), left
        else:
            for key in keys:
                left, right = right, left ^ (mixed(right ^ key) & mask)
        return left << half | right


def placed(documents: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """(key, text, slot), and how many documents there are.  ``documents`` must come from files, as a scan or a projection of one.

    What comes to the driver is a row for each input file, which it lists anyway.
    """
    place = documents.select(F.col("_metadata.file_path").alias("file"))
    sizes = sorted((r["file"], r["n"]) for r in place.groupBy("file").agg(F.count("*").alias("n")).collect())
    begins, n = {}, 0
    for file, size in sizes:
        begins[file], n = n, n + size
    order, sent = Order(n, secret), documents.sparkSession.sparkContext.broadcast(begins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(2).dictionary_encode()
            first = np.array([sent.value[f] for f in files.dictionary.to_pylist()], dtype=np.int64)
            index = first[files.indices.to_numpy()] + batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(order.slots(index))], names=["key", "text", "slot"])

    kind = dict(documents.dtypes)[key]
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return rows.mapInArrow(run, f"key {kind}, text string, slot long"), n


def write(documents: DataFrame, tokenizer: Tokenizer, path: str, secret: bytes, end: int, stride: int = 2_048, per_shard: int = PER_SHARD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards when the index is computed: (key, slot, shard, row, place, n_tokens), where a sequence begins and its length without the end id."""
    rows, n = placed(documents, secret, key, text)
    shards = max(1, -(-n // per_shard))
    width = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, open_, at = tokenizer.encoder(), None, 0
        for batch in batches:
            slots = batch.column(2).to_numpy()
            data, begins = column(batch)
            for a, b in spans(begins, AT_ONCE):
                ids, first = encoder.encode(data[begins[a] : begins[b]], begins[a : b + 1] - begins[a])
                # The end id behind each sequence.
                stream = np.insert(ids.astype(width), first[1:], end).tobytes()
                sizes = np.diff(first)
                if open_ is None:
                    open_ = Shard(path, int(slots[0] // per_shard))
                places = at + np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
                open_.write(stream)
                at += int((sizes + 1).sum())
                columns = [batch.column(0).slice(a, b - a), *map(pa.array, (slots[a:b], slots[a:b] // per_shard, places // stride, places % stride, sizes))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "slot", "shard", "row", "place", "n_tokens"])
        if open_ is not None:
            open_.write(np.full(-at % stride, end, dtype=width).tobytes())
            open_.close()

    kind = dict(rows.dtypes)["key"]
    dealt = rows.repartitionById(shards, F.expr(f"cast(slot div {per_shard} as int)")).sortWithinPartitions("slot")
    return dealt.mapInArrow(run, f"key {kind}, slot long, shard long, row long, place long, n_tokens long").withColumnRenamed("key", key)


class Shard:
    """A file that is there when it is whole."""

    def __init__(self, folder: str, number: int):
        self._fs, base = pafs.FileSystem.from_uri(folder)
        self._fs.create_dir(base, recursive=True)
        self._last = f"{base}/{name(number)}"
        self._first = f"{base}/.{name(number)}.{uuid.uuid4().hex}"
        self._out = self._fs.open_output_stream(self._first)
        self.write = self._out.write

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._first, self._last)


def name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def read(folder: str, shard: int, row: int = 0, stride: int = 2_048, width: str = "<u2") -> Iterator[np.ndarray]:
    """The rows of a shard from ``row`` on."""
    fs, base = pafs.FileSystem.from_uri(folder)
    size = stride * np.dtype(width).itemsize
    with fs.open_input_file(f"{base}/{name(shard)}") as file:
        file.seek(row * size)
        while found := file.read(size):
            yield np.frombuffer(found, dtype=width)
