"""Quality scores learnt from preferences (Bradley-Terry).

Of two labelled texts of which one is good and one is not, the good one is preferred.  The probability of a
preference is the logistic of the difference of both texts' scores; a score is linear in features of the
text, so that fitting is logistic loss on feature differences.  Scores have no zero of their own: the
threshold is the quantile of the training scores that leaves as many below as the labels have.

Fitted on ``SAMPLE`` labelled rows at most, chosen by a hash of their key; everything is scored.  Null and
empty texts have noughts for features and get the score of such a text.  Rows without a label, or whose
text is missing, take no part in fitting; a key with several labels counts as its best.  Without both kinds
of label there is nothing to prefer: every score is 0.5.  Columns of the input are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.blocks import blocks
from biblioscope.llm.stats import COUNTS, counts

#: Labelled rows a model is fitted on, at most.
SAMPLE = 20_000

#: Preferences drawn for each text of the rarer label.
PAIRS = 16

#: A ratio is also seen above each of these knots, which makes a score bend.
_KNOTS = (0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 2.0)


def remainder(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % of


def sample(labels: DataFrame, label: str, usable: Column, key: str = "doc_id", limit: int = SAMPLE) -> DataFrame:
    """(key, label) of ``limit`` usable rows with a label at most, chosen by a hash of the key; one row a key."""
    one = labels.where(usable & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("label"))
    return one.orderBy(F.xxhash64(key), key).limit(limit)


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """A row for each text."""
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    ratios = [c[k] / words for k in COUNTS if k not in ("n_words", "word_chars", "n_dup_lines", "n_lines", "n_upper", "n_lower")]
    ratios += [c["n_dup_lines"] / lines, c["n_upper"] / np.maximum(c["n_upper"] + c["n_lower"], 1)]
    columns = [np.log1p(c["n_words"]) / 10, np.log1p(words / lines) / 5, np.minimum(c["word_chars"] / words, 20) / 10]
    for ratio in ratios:
        columns.append(np.minimum(ratio, 3))
        columns += [(ratio > knot).astype(float) for knot in _KNOTS]
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the threshold."""
        return 1 / (1 + np.exp(-np.clip(x @ self.weights - self.threshold, -500, 500)))


def fit_pairs(x: np.ndarray, y: np.ndarray, rounds: int = 300, penalty: float = 1e-3, seed: int = 5) -> Ranking:
    """Bradley-Terry by gradient descent with momentum on drawn preferences."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(x.shape[1]), 0.0)
    draw = np.random.default_rng(seed)
    n = PAIRS * min(len(good), len(bad))
    # Every text of either label is in some pair.
    first = np.concatenate([good, draw.choice(good, n), draw.choice(good, len(bad))])
    second = np.concatenate([draw.choice(bad, len(good)), draw.choice(bad, n), bad])
    d = x[first] - x[second]
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    step = 1.0 / (0.25 * np.mean(np.sum(d * d, axis=1)) + penalty)
    for _ in range(rounds):
        gradient = -(d.T @ (1 / (1 + np.exp(np.clip(d @ w, -500, 500))))) / len(d) + penalty * w
        speed = 0.9 * speed - step * gradient
        w = w + speed
    scores = x @ w
    # The threshold's place between the two texts it divides does not matter for the sample.
    below = np.sort(scores)
    at = int(round(len(bad)))
    return Ranking(w, float((below[at - 1] + below[min(at, len(below) - 1)]) / 2))


def fit(documents: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> Ranking:
    """``labelled``: (key, label), as many rows as ``sample`` gives at most; it is broadcast, as its size is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                rows = batch.slice(block.rows.start, block.n)
                found = pa.array(list(np.stack([counts(block)[k] for k in COUNTS], axis=1)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), found], names=["key", "label", "counts"])

    found = documents.select(F.col(key).alias("key"), text).join(F.broadcast(labelled.withColumnRenamed(key, "key")), "key")
    kind = dict(found.dtypes)["key"]
    rows = found.select("key", F.col("label").cast("int").alias("label"), text).where(F.col(text).isNotNull())
    seen = sorted((r["key"], r["label"], r["counts"]) for r in rows.mapInArrow(run, f"key {kind}, label int, counts array<long>").collect())
    table = np.array([c for _, _, c in seen], dtype=np.int64).reshape(-1, len(COUNTS))
    return fit_pairs(features(dict(zip(COUNTS, table.T, strict=True))), np.array([y for _, y, _ in seen]))


def scored(df: DataFrame, model: Ranking, text: str = "text", score: str = "score") -> DataFrame:
    """Adds ``score``, replacing a column of that name."""
    keep = [c for c in df.columns if c != score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                rows = batch.slice(block.rows.start, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(model.score(features(counts(block))))], names=[*keep, score])

    old = df.select(*[f"`{c}`" for c in keep])
    return old.mapInArrow(run, ", ".join([f"`{c}` {t}" for c, t in old.dtypes] + [f"`{score}` double"]))
