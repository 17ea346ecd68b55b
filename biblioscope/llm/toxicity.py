"""Toxicity by multiple-instance learning.

Labels are known for documents only; a document is toxic if one of its sentences is.  A sentence's
probability is the logistic of a bias and the weights of the words and word beginnings it has; a document's
is the noisy-or of its sentences, 1 - prod(1 - p).  Both are trained together from document labels, and the
sentence probabilities then say where the offence is.

Sentences end at . ! ? or a line end.  Words are lower-cased (A-Z) runs of letters, digits and bytes above
127; beginnings are their first 4 to 8 bytes.  Of these, ``FEATURES`` that tell the labels apart best are
used.  Fitted on ``ranking.SAMPLE`` labelled rows at most, chosen by a hash of the key; all is scored.
Null and empty texts have no sentence and get the score 0.  Without both labels all scores are those of the bias.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.blocks import Block, blocks

#: Words and beginnings that have a weight, at most.
FEATURES = 3_000

_BEGINNINGS = (4, 5, 6, 7, 8)
_WORDY = np.zeros(256, dtype=bool)
_WORDY[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _WORDY[_a:_b] = True
_ENDS = np.isin(np.arange(256), list(b".!?\n"))


def sentences(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Where sentences begin, those without a word included, and the first of each document."""
    opens = np.zeros(len(block.data) + 1, dtype=bool)
    opens[block.at[:-1]] = True
    opens[np.flatnonzero(_ENDS[block.data]) + 1] = True
    begins = np.flatnonzero(opens[:-1])
    return begins, np.searchsorted(begins, block.at)


def marks(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and beginnings, and the byte each begins at."""
    inside = np.zeros(len(block.data) + 2, dtype=np.int8)
    inside[1:-1] = _WORDY[block.data]
    starts, ends = inside[1:] > inside[:-1], inside[1:] < inside[:-1]
    cut = block.at[1:-1]
    cut = cut[(inside[cut] > 0) & (inside[cut + 1] > 0)]
    starts[cut] = True
    ends[cut] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    found, at = [block.hashes(starts, ends)], [starts]
    for n in _BEGINNINGS:
        long = starts[ends - starts > n]
        found.append(block.hashes(long, long + n) ^ np.uint64(n))
        at.append(long)
    return np.concatenate(found), np.concatenate(at)


class Chosen:
    """The features that have a weight: finds them among many hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self._maybe = np.zeros(1 << 18, dtype=bool)
        self._maybe[hashes >> np.uint64(46)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are features, and their numbers."""
        which = np.flatnonzero(self._maybe[hashes >> np.uint64(46)])
        number = np.minimum(np.searchsorted(self.hashes, hashes[which]), max(len(self.hashes) - 1, 0))
        right = self.hashes[number] == hashes[which] if len(self.hashes) else np.zeros(0, dtype=bool)
        return which[right], number[right]


def bags(block: Block, chosen: Chosen) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, feature) pairs, each once, sorted; the first sentence of each document."""
    begins, first = sentences(block)
    found, at = marks(block)
    which, number = chosen(found)
    sentence = np.searchsorted(begins, at[which], "right") - 1
    pairs = np.unique(sentence.astype(np.int64) * (len(chosen.hashes) + 1) + number)
    return pairs // (len(chosen.hashes) + 1), pairs % (len(chosen.hashes) + 1), first


@dataclass(frozen=True)
class Toxicity:
    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def of_sentences(self, block: Block, chosen: Chosen) -> tuple[np.ndarray, np.ndarray]:
        """A probability for each sentence; the first sentence of each document."""
        sentence, number, first = bags(block, chosen)
        logit = self.bias + np.bincount(sentence, self.weights[number] if len(number) else None, minlength=int(first[-1]))
        return 1 / (1 + np.exp(-logit)), first


def noisy_or(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1 - prod(1 - p) by document; 0 for one without sentences."""
    sums = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
    return np.clip(1 - np.exp(np.diff(sums[first])), 0, 1)


def choose(of_toxic: np.ndarray, of_rest: np.ndarray, toxic: int, rest: int, limit: int = FEATURES) -> np.ndarray:
    """The features with the largest log-likelihood ratio among those commoner in toxic documents or, for a tenth, in the rest."""

    def term(k: np.ndarray, n: int, p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log1p(-p)

    a, b = of_toxic / max(toxic, 1), of_rest / max(rest, 1)
    both = (of_toxic + of_rest) / max(toxic + rest, 1)
    gain = term(of_toxic, toxic, a) + term(of_rest, rest, b) - term(of_toxic, toxic, both) - term(of_rest, rest, both)
    for_toxic, against = np.flatnonzero(a > b), np.flatnonzero(a <= b)
    for_toxic = for_toxic[np.argsort(-gain[for_toxic], kind="stable")][: limit - limit // 10]
    against = against[np.argsort(-gain[against], kind="stable")][: limit // 10]
    return np.concatenate([for_toxic, against])


def fit_bags(docs: np.ndarray, sentence: np.ndarray, number: np.ndarray, empty: np.ndarray, y: np.ndarray, n_features: int, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Noisy-or likelihood by Adam.

    ``docs`` is the document of each sentence that has features, ``sentence`` and ``number`` the pairs,
    ``empty`` how many sentences without features each document has.
    """
    w, bias = np.zeros(n_features), -4.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    n_sentences, n_docs = len(docs), len(y)
    for t in range(1, rounds + 1):
        logit = bias + np.bincount(sentence, w[number], minlength=n_sentences)
        p, p0 = 1 / (1 + np.exp(-logit)), 1 / (1 + np.exp(-bias))
        clean = np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n_docs) + empty * np.log1p(-p0)
        toxic = np.clip(-np.expm1(clean), 1e-9, 1)
        # d loss / d logit of a sentence is p times this, by document.
        pull = np.where(y == 1, -(1 - toxic) / toxic, 1.0) / n_docs
        by_sentence = pull[docs] * p
        gradient = np.bincount(number, by_sentence[sentence], minlength=n_features) + 2e-5 * w
        gradient = np.append(gradient, by_sentence.sum() + (pull * empty).sum() * p0)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], min(bias - step[-1], -2.0)
    return w, float(bias)


def fit(documents: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> Toxicity:
    """``labelled``: (key, label), a bounded sample, which is broadcast.

    The sample's documents are read twice: for the counts of features by label, added up where they are,
    and for the bags of the chosen features, the only things that come to the driver.
    """
    joined = documents.select(F.col(key).alias("key"), text).join(F.broadcast(labelled.withColumnRenamed(key, "key")), "key")
    rows = joined.where(F.col(text).isNotNull()).select(F.col("label").cast("int").alias("label"), text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch, text, lower=True):
                found, at = marks(block)
                doc = np.searchsorted(block.at, at, "right") - 1
                order = np.lexsort((doc, found))
                found, doc = found[order], doc[order]
                once = np.ones(len(found), dtype=bool)
                once[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
                found, toxic = found[once], label[block.rows][doc[once]]
                opens = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, dtype=int)
                of_toxic = np.add.reduceat(toxic, opens) if len(found) else toxic
                total = np.diff(np.append(opens, len(found)))
                yield pa.RecordBatch.from_arrays([pa.array(found[opens].view(np.int64)), pa.array(of_toxic.astype(np.int64)), pa.array((total - of_toxic).astype(np.int64))], names=["h", "toxic", "rest"])

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, rest = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not rest:
        return Toxicity(np.zeros(0, dtype=np.uint64), np.zeros(0), -4.0)
    sums = rows.mapInArrow(count, "h long, toxic long, rest long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("rest").alias("rest"))
    # The share in either label orders features as the likelihood ratio does, near enough to cut the list to a bounded length.
    gap = F.abs(F.col("toxic") / toxic - F.col("rest") / rest) / F.sqrt((F.col("toxic") + F.col("rest") + 1.0) / (toxic + rest))
    listed = sums.where(F.col("toxic") + F.col("rest") >= 3).orderBy(gap.desc(), "h").limit(10 * FEATURES).collect()
    h = np.array([r["h"] for r in listed], dtype=np.int64).view(np.uint64)
    best = choose(np.array([r["toxic"] for r in listed], dtype=float), np.array([r["rest"] for r in listed], dtype=float), toxic, rest)
    chosen = Chosen(h[best])

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch, text, lower=True):
                sentence, number, first = bags(block, chosen)
                for i in range(block.n):
                    a, b = np.searchsorted(sentence, [first[i], first[i + 1]])
                    own = sentence[a:b] - first[i]
                    yield_row = (int(label[block.rows.start + i]), int(first[i + 1] - first[i]), own.tolist(), number[a:b].tolist())
                    yield pa.RecordBatch.from_pylist([dict(zip(("label", "sentences", "sentence", "number"), yield_row, strict=True))], schema=_BAG)

    seen = rows.mapInArrow(bag, "label int, sentences long, sentence array<long>, number array<long>").collect()
    seen = sorted((r["label"], r["sentences"], r["sentence"], r["number"]) for r in seen)
    docs, sentence, number, empty, base = [], [], [], [], 0
    for i, (_, n, own, numbers) in enumerate(seen):
        distinct, index = np.unique(np.array(own, dtype=np.int64), return_inverse=True)
        docs.append(np.full(len(distinct), i))
        sentence.append(index + base)
        number.append(np.array(numbers, dtype=np.int64))
        empty.append(n - len(distinct))
        base += len(distinct)
    w, bias = fit_bags(np.concatenate(docs), np.concatenate(sentence), np.concatenate(number), np.array(empty, dtype=float), np.array([r[0] for r in seen]), len(chosen.hashes))
    return Toxicity(chosen.hashes, w, bias)


_BAG = pa.schema([("label", pa.int32()), ("sentences", pa.int64()), ("sentence", pa.list_(pa.int64())), ("number", pa.list_(pa.int64()))])


def scored(df: DataFrame, model: Toxicity, text: str = "text", score: str = "score", offending: str | None = "offending", at_least: float = 0.5) -> DataFrame:
    """Adds ``score`` and, by bytes of the text, begin and end of the sentences with ``at_least`` that probability; replaces such columns."""
    added = [score] + ([offending] if offending else [])
    keep = [c for c in df.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(model.hashes)
        for batch in batches:
            for block in blocks(batch, text, lower=True):
                p, first = model.of_sentences(block, chosen)
                more = [pa.array(noisy_or(p, first))]
                if offending:
                    begins = np.append(sentences(block)[0], len(block.data))
                    hit = np.flatnonzero(p >= at_least)
                    doc = np.searchsorted(first, hit, "right") - 1
                    spans = np.stack([begins[hit], begins[hit + 1]], axis=1) - block.at[doc][:, None]
                    inner = pa.ListArray.from_arrays(pa.array(2 * np.arange(len(hit) + 1), pa.int32()), pa.array(spans.ravel(), pa.int64()))
                    more.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(block.n + 1)), pa.int32()), inner))
                rows = batch.slice(block.rows.start, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*keep, *added])

    old = df.select(*[f"`{c}`" for c in keep])
    schema = [f"`{c}` {t}" for c, t in old.dtypes] + [f"`{score}` double"] + ([f"`{offending}` array<array<long>>"] if offending else [])
    return old.mapInArrow(run, ", ".join(schema))
