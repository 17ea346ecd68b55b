"""Byte-level BPE by prefix dynamic programming.

The merges' encoding of a byte string has a prefix property: the encoding of every prefix ends in one
token that depends on the prefix alone.  So one table per string, the last token of each prefix, holds
the encodings of all prefixes: a token that ends at i is the right one exactly if it may stand beside
the last token of the prefix in front of it.  Reading the table from the end back gives the encoding;
appending only adds entries; after an edit the table is recomputed from there until it agrees with the
old one over the length of the longest token.

Texts are cut by the tokenizer's pattern first; each match is encoded by itself.  Special tokens are not
recognised.  Null texts count as empty and give no tokens; lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache, cached_property
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from biblioscope.llm.blocks import Block, column, mixed, spans

#: Pieces, and pairs of tokens, that a Python worker remembers at least; of the older ones it forgets.
CACHE = 200_000

#: Longer pieces (bytes) are encoded one by one and not remembered.
LONG = 64

#: Bytes of text encoded at a time.
AT_ONCE = 1 << 20

#: Letters and numbers that Unicode has had since version 17, which the library's tables do not know.
_NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]


def read_ranks(path: str | Path) -> dict[bytes, int]:
    """A rank file: a line for each token, base64 and its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Merges of neighbours in order of rank, as far as ``below``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Recent:
    """What was put in lately: the last ``size`` entries at least, twice as many at most."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value):
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value
        return value

    def __getstate__(self) -> dict:
        return {"size": self.size, "new": {}, "old": {}}


class Vocabulary:
    """Tokens, how each was merged, and which may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                left, right = merged(token, ranks, rank)
                self.parts[rank] = ranks[left], ranks[right]
        self.joined = {pair: rank for rank, pair in self.parts.items()}
        self._pairs = Recent(5 * CACHE)

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes give just these two tokens.

        Undoes the merges at the border, the latest first; a pair at the border that would have merged
        before the parts it is seen with were made contradicts.
        """
        joined, parts = self.joined, self.parts
        before = 1 << 62
        while True:
            rank = joined.get((left, right))
            if rank is not None and rank < before:
                return False
            l_parts, r_parts = parts.get(left), parts.get(right)
            if l_parts and (left > right or not r_parts):
                before, left = left, l_parts[1]
            elif r_parts:
                before, right = right + 1, r_parts[0]
            else:
                return True

    @cached_property
    def _automaton(self) -> ahocorasick.Automaton:
        """Finds the tokens that end at each byte, the longest first."""
        found = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            found.add_word(token.decode("latin-1"), (rank, len(token)))
        found.make_automaton()
        return found

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"}

    def last_tokens(self, text: bytes, start: int, last: list[int]) -> Iterator[int]:
        """Yields the last token of each prefix longer than ``start`` and notes it in ``last``, which has those up to there."""
        pairs, done = self._pairs, start
        window = max(0, start + 1 - self.longest)
        for end, (token, n) in self._automaton.iter(text[window:].decode("latin-1")):
            end += window + 1
            if end <= done:
                continue
            left = last[end - n]
            if left >= 0:
                pair = left << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs.put(pair, self.neighbours(left, token))
                if not fits:
                    continue
            elif end > n:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            done = end
            yield token

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return Prefixes(self, piece).ids()


class Lookup:
    """Positions of 64-bit keys, for arrays of keys: open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self._shift = np.uint64(64 - (4 * len(keys)).bit_length())
        slots = 1 << int(64 - self._shift)
        self._mask = slots - 1
        self._keys, self._values = np.zeros(slots, dtype=np.uint64), np.full(slots, -1, dtype=np.int32)
        for key, value in zip(keys, values, strict=True):
            slot = int(key >> self._shift)
            while self._values[slot] >= 0:
                slot = (slot + 1) & self._mask
            self._keys[slot], self._values[slot] = key, value

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        slots = (keys >> self._shift).astype(np.int64)
        out = self._values[slots]
        open_ = np.flatnonzero((out >= 0) & (self._keys[slots] != keys))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self._mask
            out[open_] = self._values[slots[open_]]
            open_ = open_[(out[open_] >= 0) & (self._keys[slots[open_]] != keys[open_])]
        return out


class ManyPieces:
    """The prefix tables of many short pieces at once, one length of prefix after the other."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        tokens = list(v.ranks)
        raw = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        at = np.concatenate([[0], np.cumsum([len(x) for x in tokens])])
        keys = Block(raw, at, slice(0, len(tokens))).hashes(at[:-1], at[1:])
        self._tokens = Lookup(keys, np.array([v.ranks[x] for x in tokens]))
        self._lengths = sorted({len(x) for x in tokens})
        size = max(v.bytes_of) + 1
        self._left, self._right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.sizes = np.zeros(size, dtype=np.int64)
        for rank, (left, right) in v.parts.items():
            self._left[rank], self._right[rank] = left, right
        for rank, token in v.bytes_of.items():
            self.sizes[rank] = len(token)
        pairs = np.array([left << 32 | right for left, right in v.joined], dtype=np.uint64)
        self._joined = Lookup(mixed(pairs), np.array(list(v.joined.values())))

    def _neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As ``Vocabulary.neighbours``, for arrays."""
        fits = np.zeros(len(left), dtype=bool)
        at = np.arange(len(left))
        before = np.full(len(left), 1 << 62, dtype=np.int64)
        while len(at):
            rank = self._joined(mixed((left << 32 | right).astype(np.uint64)))
            on = (rank < 0) | (rank >= before)
            if not on.all():
                at, left, right, before = at[on], left[on], right[on], before[on]
            of_left, of_right = self._right[left], self._left[right]
            undo_left = (of_left >= 0) & ((left > right) | (of_right < 0))
            undo_right = ~undo_left & (of_right >= 0)
            before = np.where(undo_left, left, right + 1)
            left = np.where(undo_left, of_left, left)
            right = np.where(undo_right, of_right, right)
            on = undo_left | undo_right
            if not on.all():
                fits[at[~on]] = True
                at, left, right, before = at[on], left[on], right[on], before[on]
        return fits

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(x) for x in pieces], dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        block = Block(raw, at, slice(0, len(pieces)))
        reach = np.arange(1, len(raw) + 1) - np.repeat(at[:-1], sizes)  # length of the prefix that ends with each byte
        ends, found, lens = [], [], []
        for n in self._lengths:
            stop = np.flatnonzero(reach >= n) + 1
            if not len(stop):
                break
            token = self._tokens(block.hashes(stop - n, stop))
            hit = token >= 0
            ends.append(stop[hit])
            found.append(token[hit])
            lens.append(np.full(int(hit.sum()), n, dtype=np.int64))
        end, token, n = np.concatenate(ends), np.concatenate(found).astype(np.int64), np.concatenate(lens)
        depth = reach[end - 1]
        order = np.argsort(depth, kind="stable")
        end, token, n, depth = end[order], token[order], n[order], depth[order]
        cuts = np.searchsorted(depth, np.arange(1, sizes.max() + 2))
        last = np.full(len(raw) + 1, -1, dtype=np.int64)  # at a prefix's end, its last token
        for a, b in zip(cuts, cuts[1:], strict=False):
            e, t, k = end[a:b], token[a:b], n[a:b]
            whole = depth[a:b] == k
            fits = whole.copy()
            rest = np.flatnonzero(~whole)
            fits[rest] = self._neighbours(last[e[rest] - k[rest]], t[rest])
            last[e[fits]] = t[fits]
        out, of = [], []
        where, piece = at[1:].copy(), np.arange(len(pieces))
        while len(piece):
            ids = last[where]
            out.append(ids)
            of.append(piece)
            where = where - self.sizes[ids]
            on = where > at[piece]
            where, piece = where[on], piece[on]
        ids, of = np.concatenate(out[::-1]), np.concatenate(of[::-1])
        order = np.argsort(of, kind="stable")
        return ids[order].astype("<u4"), np.bincount(of, minlength=len(pieces))


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.vocabulary, self.text, self.last = vocabulary, b"", [-1]
        self.append(text)

    def append(self, more: bytes) -> None:
        start, self.text = len(self.text), self.text + more
        for _ in self.vocabulary.last_tokens(self.text, start, self.last):
            pass
        if len(self.last) != len(self.text) + 1:
            raise ValueError("the vocabulary lacks a byte")

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces bytes [start, end); returns how many entries were computed anew."""
        old, shift, reach = self.last, start + len(new) - end, self.vocabulary.longest
        self.text = self.text[:start] + new + self.text[end:]
        self.last = old[: start + 1]
        same = 0
        for at, token in enumerate(self.vocabulary.last_tokens(self.text, start, self.last), start + 1):
            # Beyond the edit, entries that agree for the longest token's length agree for good.
            same = same + 1 if at - shift > end and old[at - shift] == token else 0
            if same >= reach:
                self.last += old[at - shift + 1 :]
                return at - start
        return len(self.text) - start

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the text, or of a prefix."""
        out, at = [], len(self.text) if end is None else end
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


@cache
def _classes() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 anything else, by code point."""
    kinds = np.full(0x110000, 3, dtype=np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (0, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, every):
            span = np.frombuffer(run.group().encode("utf-32-le"), dtype=np.uint32)
            kinds[span] = kind
    for a, b in _NEWER:
        kinds[a : b + 1] = 3
    return kinds


def cut(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the matches of the pattern begin, in bytes, and the first match of each document.

    The pattern: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+.  Every character
    belongs to one match, so matches are the runs of a kind of character with three changes: the last blank
    in front of a run belongs to it, a white-space run gives up its last character otherwise, and an
    apostrophe that opens a match takes the letters of a contraction.
    """
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    places = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(points)
    kind = _classes()[points]
    opens = np.zeros(n + 4, dtype=bool)  # a document begins here
    bounds = np.searchsorted(places, at)
    opens[bounds] = True
    start = np.empty(n, dtype=bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= opens[:n]
    after = np.flatnonzero(start[1:] & ~opens[1:n] & (kind[1:] != 0) & (kind[:-1] == 0)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False

    quote = np.flatnonzero(start & (points == 39))
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, dtype=np.uint32)])
        one, two = padded[quote + 1], padded[quote + 2]
        in_one = ~opens[quote + 1]
        in_two = in_one & ~opens[quote + 2]
        short = in_one & np.isin(one, [115, 116, 109, 100])  # s t m d
        long = in_two & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))  # re ve ll
        for chosen, size in ((short, 2), (long & ~short, 3)):
            p = quote[chosen]
            for k in range(1, size):
                start[p + k] = False
            q = p + size
            start[q[q < n]] = True
    starts = np.flatnonzero(start)
    return places[starts], np.searchsorted(starts, bounds)


class Encoder:
    """Encodes blocks of documents; remembers the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known, self._many = vocabulary, Recent(CACHE), ManyPieces(vocabulary)
        size = max(vocabulary.bytes_of) + 1
        tokens = [vocabulary.bytes_of.get(i, b"") for i in range(size)]
        self._flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self._sizes = np.array([len(x) for x in tokens], dtype=np.int64)
        self._begins = np.cumsum(self._sizes) - self._sizes

    def _packed(self, pieces: list[bytes]) -> list[bytes]:
        known = self.known
        packed = [known.get(x) for x in pieces]
        if None in packed:
            new = [i for i, x in enumerate(packed) if x is None]
            short = [i for i in new if len(pieces[i]) < LONG]
            if short:
                ids, sizes = self._many.encode([pieces[i] for i in short])
                ids, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
                for i, a, b in zip(short, [0, *ends], ends, strict=False):
                    packed[i] = known.put(pieces[i], ids[a:b])
            for i in new:
                if packed[i] is None:
                    packed[i] = np.array(self.vocabulary.encode(pieces[i]), dtype="<u4").tobytes()
        return packed

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents and where each one's begin."""
        starts, first = cut(data, at)
        if not len(starts):
            return np.zeros(0, dtype="<u4"), np.zeros(len(at), dtype=np.int64)
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        packed = self._packed(pieces.dictionary.to_pylist())
        which = pieces.indices.to_numpy()
        flat = np.frombuffer(b"".join(packed), dtype="<u4")
        sizes = np.fromiter((len(x) >> 2 for x in packed), dtype=np.int64, count=len(packed))
        ids, ends = gathered(flat, np.cumsum(sizes) - sizes, sizes, which)
        return ids, np.concatenate([[0], ends])[first]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and where each id's end."""
        return gathered(self._flat, self._begins, self._sizes, ids)


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``flat``, one behind the other, and where each ends."""
    n = sizes[which]
    ends = np.cumsum(n)
    if not len(ends):
        return flat[:0], ends
    at = np.repeat(begins[which] - (ends - n), n)
    at += np.arange(ends[-1])
    return flat[at], ends


_encoders: dict[str, Encoder] = {}


class Tokenizer:
    """A vocabulary for Spark jobs: read once on the driver, sent to the executors (its size is fixed)."""

    def __init__(self, spark: SparkSession, path: str | Path):
        vocabulary = Vocabulary(read_ranks(path))
        self.key = hashlib.sha256(repr(sorted(vocabulary.ranks.items())).encode()).hexdigest()
        self._sent = spark.sparkContext.broadcast(vocabulary)

    def encoder(self) -> Encoder:
        """On an executor: this worker's encoder."""
        if self.key not in _encoders:
            _encoders[self.key] = Encoder(self._sent.value)
        return _encoders[self.key]


def encode(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids", checked: str | None = None) -> DataFrame:
    """Adds the column ``ids`` (array of int) and, if named, ``checked``: whether decoding them gives the text's bytes again.

    Columns of these names are replaced.  Null text: no ids, which decode to the empty text.
    """
    added = [ids] + ([checked] if checked else [])
    keep = [c for c in df.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        for batch in batches:
            data, at = column(batch, text)
            for a, b in spans(at, AT_ONCE):
                found, first = encoder.encode(data[at[a] : at[b]], at[a : b + 1] - at[a])
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(found.astype(np.int32)))
                columns = [*batch.slice(a, b - a).columns, lists]
                if checked:
                    raw, ends = encoder.decode(found)
                    ends, begins = np.concatenate([[0], ends])[first], at[a : b + 1] - at[a]
                    same = [np.array_equal(raw[ends[i] : ends[i + 1]], data[at[a] + begins[i] : at[a] + begins[i + 1]]) for i in range(b - a)]
                    columns.append(pa.array(same))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])

    schema = ", ".join([f"`{c}` {t}" for c, t in df.select(*[f"`{c}`" for c in keep]).dtypes] + [f"`{ids}` array<int>"] + [f"`{c}` boolean" for c in added[1:]])
    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the column ``text``, the bytes of the ids read as UTF-8, replacing one of that name.

    Null ids: empty.  Bytes that are not UTF-8, as a cut sequence may have them, become U+FFFD.
    """
    keep = [c for c in df.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        for batch in batches:
            lists = batch.column(keep.index(ids))
            texts = []
            for i in range(batch.num_rows):
                found = lists[i].values
                found = np.zeros(0, dtype=np.int64) if found is None else found.to_numpy(zero_copy_only=False)
                texts.append(encoder.decode(found)[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, text])

    schema = ", ".join([f"`{c}` {t}" for c, t in df.select(*[f"`{c}`" for c in keep]).dtypes] + [f"`{text}` string"])
    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def round_trip(df: DataFrame, tokenizer: Tokenizer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the ids as little-endian 32-bit integers and of the bytes decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        for batch in batches:
            data, at = column(batch, text)
            counts, ids_sha, text_sha = [], [], []
            for a, b in spans(at, AT_ONCE):
                ids, first = encoder.encode(data[at[a] : at[b]], at[a : b + 1] - at[a])
                raw, ends = encoder.decode(ids)
                ends = np.concatenate([[0], ends])[first]
                for i in range(b - a):
                    ids_sha.append(hashlib.sha256(ids[first[i] : first[i + 1]]).hexdigest())
                    text_sha.append(hashlib.sha256(raw[ends[i] : ends[i + 1]]).hexdigest())
                counts.append(np.diff(first))
            n = pa.array(np.concatenate(counts) if counts else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
