"""Counts of each text that quality rules and quality scores are made of."""

from __future__ import annotations

import numpy as np

from biblioscope.llm.blocks import Block, mixed, shingles

_UPPER, _LOWER, _DIGIT = (np.isin(np.arange(256), range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_LEADS = (np.arange(256) & 0xC0) != 0x80  # bytes a character begins with

#: The counts, all of them integers.  Characters are code points.
COUNTS = (
    "n_words",  # runs of other characters than blanks and \t \n \v \f \r
    "word_chars",  # characters in words
    "n_symbols",  # characters of #*$%&|<>
    "n_dup_lines",  # lines with a word that equal an earlier line
    "n_repeat_words",  # words in windows of three words that occur twice or more
    "n_lines",  # lines with a word
    "n_upper",  # A-Z
    "n_lower",  # a-z
    "n_digits",  # 0-9
    "n_stops",  # full stops
    "n_exclaims",  # exclamation marks
    "n_distinct_words",
    "n_short_words",  # words of one character
    "n_long_words",  # words of more than 20 characters
    "n_same_as_last",  # words that equal the word before
)


def repeated(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which elements occur twice or more in their document; which of those come after their first occurrence."""
    twice, later = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
    if len(hashes) > 1:
        keys = hashes ^ mixed(doc.astype(np.uint64) + np.uint64(1))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice[order[1:]] = same
        later[order[1:]] = same
        twice[order[:-1]] |= same
    return twice, later


def counts(block: Block) -> dict[str, np.ndarray]:
    """Each of ``COUNTS`` by document.  An empty text has noughts."""
    data, at = block.data, block.at
    starts, ends, first = block.words()
    n_words = np.diff(first)

    def of_bytes(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return np.diff(sums[at])

    def of_words(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return np.diff(sums[first])

    leads = np.concatenate([[0], np.cumsum(_LEADS[data])])
    sizes = leads[ends] - leads[starts]
    words, doc = block.hashes(starts, ends), block.doc_of(first)

    opens, closes, first_line = block.lines()
    wordy = np.searchsorted(starts, closes) > np.searchsorted(starts, opens)
    lines_doc = block.doc_of(first_line)[wordy]
    _, again = repeated(block.hashes(opens[wordy], closes[wordy]), lines_doc)

    windows, begins = shingles(words, first, 3)
    full = np.repeat(n_words >= 3, np.diff(begins))
    twice, _ = repeated(windows, block.doc_of(begins))
    where = np.flatnonzero(twice & full)
    where = where - np.repeat(begins[:-1], np.diff(begins))[where] + np.repeat(first[:-1], np.diff(begins))[where]
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[where + k] = True

    _, seen = repeated(words, doc)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    return {
        "n_words": n_words,
        "word_chars": of_words(sizes),
        "n_symbols": of_bytes(_SYMBOL),
        "n_dup_lines": np.bincount(lines_doc[again], minlength=block.n),
        "n_repeat_words": of_words(covered),
        "n_lines": np.bincount(lines_doc, minlength=block.n),
        "n_upper": of_bytes(_UPPER),
        "n_lower": of_bytes(_LOWER),
        "n_digits": of_bytes(_DIGIT),
        "n_stops": of_bytes(np.arange(256) == ord(".")),
        "n_exclaims": of_bytes(np.arange(256) == ord("!")),
        "n_distinct_words": n_words - of_words(seen),
        "n_short_words": of_words(sizes == 1),
        "n_long_words": of_words(sizes > 20),
        "n_same_as_last": of_words(same),
    }
