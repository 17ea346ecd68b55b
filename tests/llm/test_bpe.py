import base64
import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken

from biblioscope.llm import bpe, queries
from tests.llm.conftest import SF_DIR

PATH = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(encoder, texts):
    raw = [t.encode() for t in texts]
    ids, first = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]


def test_encodes_as_the_library_does(vocabulary, library):
    rnd = random.Random(3)
    signs = [*"abc st're''\"  \n\n\t\x1c\x1f\x85 éßç 12²½Ⅷ中文🙂👩‍👩$%&<|IT'LLve"] + [chr(rnd.choice([rnd.randrange(1, 0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(80)]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(2000)]
    texts += ["", " ", "'s 's ''s don't I'll we've he'd'll 're", "a" * 2000, " " * 300, "ab" * 40 + "'ve", "<|endoftext|>"]
    assert encoded(bpe.Encoder(vocabulary), texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_librarys_class():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
        found = tiktoken.Encoding("o", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}).encode_ordinary(every)
        assert np.flatnonzero(bpe._classes() == kind).tolist() == sorted(map(ord, bytes(found).decode()))


def test_one_piece_and_many_pieces_agree(vocabulary):
    rnd = random.Random(5)
    pieces = list({bytes(rnd.choice(b"thandre \xc3\xa9ing") for _ in range(rnd.randrange(1, 40))) for _ in range(500)})
    ids, sizes = bpe.ManyPieces(vocabulary).encode(pieces)
    ends = np.cumsum(sizes)
    assert [ids[b - n : b].tolist() for b, n in zip(ends, sizes, strict=True)] == [bpe.Prefixes(vocabulary, p).ids() for p in pieces]


def test_appends_and_edits_keep_the_table_exact(vocabulary):
    rnd = random.Random(7)
    table = bpe.Prefixes(vocabulary, b"the and ther")
    table.append(b"ening of")
    assert table.last == bpe.Prefixes(vocabulary, b"the and therening of").last
    text = b"thationing there " * 40
    table = bpe.Prefixes(vocabulary, text)
    for _ in range(60):
        a = rnd.randrange(len(text))
        b, new = min(len(text), a + rnd.randrange(6)), bytes(rnd.choice(b"aehnt ") for _ in range(rnd.randrange(6)))
        text = text[:a] + new + text[b:]
        computed = table.edit(a, b, new)
        assert table.text == text and table.last == bpe.Prefixes(vocabulary, text).last
        assert computed <= len(text) - a
    assert bpe.Prefixes(vocabulary, text).ids(25) == bpe.Prefixes(vocabulary, text[:25]).ids()


def test_prefix_encodings_are_the_merges(vocabulary):
    text = b" thelanationing'ss"
    table = bpe.Prefixes(vocabulary, text)
    for end in range(1, len(text) + 1):
        assert [vocabulary.bytes_of[i] for i in table.ids(end)] == bpe.merged(text[:end], vocabulary.ranks, 1 << 60)


def test_query_agrees_with_the_library(spark, documents, library):
    rows = {r["doc_id"]: r for r in queries.op1_byte_bpe(spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, *_ in documents:
        ids = library.encode_ordinary(text)
        assert rows[doc_id]["n_tokens"] == len(ids)
        assert rows[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert rows[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd, none, tokenizer, library):
    rows = bpe.decode(bpe.encode(odd.withColumnRenamed("text", "old"), tokenizer, "old"), tokenizer).collect()
    assert len(rows) == 9
    for row in rows:
        assert row["text"] == (row["old"] or "") and row["ids"] == library.encode_ordinary(row["old"] or "")
    assert bpe.encode(none, tokenizer).collect() == [] and bpe.round_trip(none, tokenizer).collect() == []
    assert bpe.round_trip(odd.where("doc_id = 1"), tokenizer).first()["ids_sha256"] == hashlib.sha256(b"").hexdigest()
