"""Texts cut into prefix, middle and suffix for fill-in-the-middle training, and put together again.

The method is repeated-capture matching: one ``fullmatch`` of ``(unit)*`` keeps every repetition of its
group, so ``ends(1)`` of the match has as many entries as the text has units, and the entry of a unit is
where it ends.  The number of units and both cuts are read off there; nothing walks over the text.

A unit is a word with the white space before it, or the white space at the end of the text.  Which units
are cut behind, and whether and in which order the parts are put together, follows from four numbers that
are hashed from the seed and the document's id: a document has one outcome, wherever and however often it
is computed.

Null texts are empty; empty texts, and texts that contain one of the marks, stay ``plain``, so that every
output can be taken apart.  Rows that share an id are cut at the same numbers, each by its own units; a null
id counts as an id without digits.  Bytes that are not UTF-8 count as one code point each and come back as
they were.  Memory follows the block of texts (``blocks.BLOCK``) or the longest text: the match holds about 20
bytes for each byte of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.blocks import column, spans

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in percent: documents that are transformed, and those of them whose suffix comes first.
RATE, SPM = 50, 80
SEED = 42

# No unit gives anything back to the one before: the possessive repeat finds what a greedy one would.
_UNITS = regex.compile(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*+")

_NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64()]


def numbers(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2^32, the first 8-digit groups of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """The number of units, and where prefix and middle end."""
    ends = _UNITS.fullmatch(text).ends(1)
    n = len(ends)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, ends[a - 1] if a else 0, ends[b - 1] if b else 0


def arranged(text: str, h: tuple[int, int, int, int], rate: int = RATE, spm: int = SPM) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and output of one text."""
    n, a, b = cut(text, h[0], h[1])
    if not text or h[2] % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transformed(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Adds n, form, prefix_chars, middle_chars and output, replacing columns of these names; key and text are left as they are."""
    keep = [c for c in df.columns if c not in _NAMES or c in (key, text)]
    hashed = df.select(*[F.col(f"`{c}`") for c in keep], F.array(*numbers(F.col(f"`{key}`"), seed)))
    kinds = dict(hashed.dtypes)
    # Clashing names cannot disturb the batches, whose columns go by place.
    places, at = [f"c{i}" for i in range(len(keep))], keep.index(text)
    placed = hashed.toDF(*places, "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in spans(column(batch, f"c{at}")[1]):
                part = batch.slice(i, j - i)
                texts = ((x or b"").decode("utf-8", "surrogateescape") for x in part.column(at).cast(pa.binary()).to_pylist())
                made = [arranged(x, h, rate, spm) for x, h in zip(texts, part.column(len(places)).to_pylist(), strict=True)]
                *counts, outputs = zip(*made, strict=True)
                encoded = pa.array([x.encode("utf-8", "surrogateescape") for x in outputs], pa.binary())
                added = [pa.array(x, kind) for x, kind in zip(counts, _KINDS, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *added, encoded], names=[*places, *_NAMES])

    schema = ", ".join(f"c{i} {kinds[c]}" for i, c in enumerate(keep)) + ", n long, form string, prefix_chars long, middle_chars long, output binary"
    made = placed.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))
    return made.toDF(*keep, *_NAMES)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone.

    An output that is not plain has each mark once, as texts with a mark are left plain.
    """

    def parts(one: str, two: str, three: str) -> list[Column]:
        behind = F.substring_index(output, one, -1)
        rest = F.substring_index(behind, two, -1)
        return [F.substring_index(behind, two, 1), F.substring_index(rest, three, 1), F.substring_index(rest, three, -1)]

    prefix, suffix, middle = parts(PREFIX, SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX, MIDDLE)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
