"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a text.  A label model says how far each rule can be
trusted: expectation-maximisation over the counts of vote patterns of the whole corpus, without labels,
estimates the share of good texts and each rule's accuracy where it votes.  A text's posterior probability
of being good replaces the demand that it pass every rule.  What the driver sees is one count for each
pattern of votes, of which there are 3^rules at most.

Null texts count as empty.  An empty text has noughts for counts and fails the base limits.  Repeated rows
are judged each by itself.  Columns of the input that bear a result's name are replaced.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.blocks import blocks
from biblioscope.llm.stats import COUNTS, counts

RULES = ("symbols", "capitals", "repeated_lines", "repeated_words", "stutter", "few_words", "prose", "varied", "punctuated")
BASE = COUNTS[:5]


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """A column for each of ``RULES``, a row for each text: 1 good, -1 bad, 0 abstains."""

    def share(part: str, whole: np.ndarray) -> np.ndarray:
        return c[part] / np.maximum(whole, 1)

    words, letters = c["n_words"], c["n_upper"] + c["n_lower"]
    symbols, capitals = share("n_symbols", words), share("n_upper", letters)
    lines, repeats, stutter = share("n_dup_lines", c["n_lines"]), share("n_repeat_words", words), share("n_same_as_last", words)
    distinct, stops, exclaims = share("n_distinct_words", words), share("n_stops", words), share("n_exclaims", words)
    length = c["word_chars"] / np.maximum(words, 1)
    bad = [symbols > 0.1, (capitals > 0.4) & (letters >= 20), lines > 0.4, repeats > 0.4, stutter > 0.2, (distinct < 0.2) & (words <= 2000)]
    good = [
        (symbols < 0.02) & (capitals < 0.2) & (length > 2.5) & (length < 12),
        (repeats < 0.2) & (stutter < 0.1) & (lines < 0.4),
        (stops > 0.01) & (stops < 0.5) & (exclaims < 0.1) & (symbols < 0.1),
    ]
    return np.stack([-x.astype(np.int64) for x in bad] + [x.astype(np.int64) for x in good], axis=1)


def code(v: np.ndarray) -> np.ndarray:
    """One number for each row of votes."""
    return (v + 1) @ (3 ** np.arange(v.shape[1]))


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and how each rule votes on bad and on good ones.

    ``chances[r][y]`` are the probabilities that rule r votes bad, abstains and votes good on a text of
    kind y (0 bad, 1 good).  Abstaining tells something too: most bad texts break only one rule, and are
    known by what the rules for good texts do not say.
    """

    prior: float
    chances: np.ndarray

    @property
    def accuracy(self) -> dict[str, float]:
        """The share of each rule's votes that are right."""
        by_kind = self.chances * np.array([1 - self.prior, self.prior])[:, None]
        right, voted = by_kind[:, 0, 0] + by_kind[:, 1, 2], by_kind[:, :, 0].sum(axis=1) + by_kind[:, :, 2].sum(axis=1)
        return dict(zip(RULES, (right / voted).tolist(), strict=True))

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        odds = np.full(len(v), np.log(self.prior / (1 - self.prior)))
        for rule in range(v.shape[1]):
            odds += np.log(self.chances[rule, 1] / self.chances[rule, 0])[v[:, rule] + 1]
        return 1 / (1 + np.exp(-odds))


def fit_patterns(v: np.ndarray, n: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns ``v`` seen ``n`` times, from the majority of the votes.

    Each chance starts as if a hundredth of the texts had been seen beforehand, on which rules are right in
    nine votes of ten; so no chance is 0, and a rule that never votes stays at that.
    """
    n = n.astype(float)
    before = 0.01 * max(n.sum(), 100.0)
    assumed = np.array([[[0.18, 0.80, 0.02], [0.02, 0.80, 0.18]]]) * before
    balance = v.sum(axis=1)
    good = np.where(balance > 0, 0.9, np.where(balance < 0, 0.1, 0.5))
    model = None
    for _ in range(rounds):
        kinds = np.stack([n * (1 - good), n * good])
        chances = np.stack([kinds @ (v == vote) for vote in (-1, 0, 1)], axis=2).transpose(1, 0, 2) + assumed
        chances /= chances.sum(axis=2, keepdims=True)
        model = LabelModel(float((kinds[1].sum() + 0.8 * before) / (n.sum() + before)), chances)
        new = model.posterior(v)
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return model


def fit(df: DataFrame, text: str = "text") -> LabelModel:
    """The label model of a corpus, from all its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                codes, n = np.unique(code(votes(counts(block))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    seen = df.select(text).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    seen = sorted((row["code"], row["n"]) for row in seen)
    codes = np.array([c for c, _ in seen], dtype=np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(RULES)) % 3 - 1
    return fit_patterns(patterns, np.array([n for _, n in seen], dtype=np.int64))


def _judged(c: dict[str, np.ndarray], model: LabelModel, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    good = model.posterior(votes(c))
    return failed, good, ~failed & (good >= threshold)


def judged(df: DataFrame, model: LabelModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Adds the base counts, base_failed, p_good (posterior) and kept: not base_failed and p_good >= threshold."""
    added = [*BASE, "base_failed", "p_good", "kept"]
    keep = [c for c in df.columns if c not in added or c == text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                c = counts(block)
                more = [pa.array(c[k], pa.int64()) for k in BASE] + [pa.array(x) for x in _judged(c, model, threshold)]
                rows = batch.slice(block.rows.start, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*keep, *added])

    old = df.select(*[f"`{c}`" for c in keep])
    schema = ", ".join([f"`{c}` {t}" for c, t in old.dtypes] + [f"{k} long" for k in BASE] + ["base_failed boolean, p_good double, kept boolean"])
    return old.mapInArrow(run, schema)


def filtered(df: DataFrame, model: LabelModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows that are kept, with their columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                kept = _judged(counts(block), model, threshold)[2]
                yield batch.slice(block.rows.start, block.n).filter(pa.array(kept))

    return df.mapInArrow(run, df.schema)
