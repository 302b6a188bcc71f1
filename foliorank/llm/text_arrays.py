"""Words and word n-grams of many texts at once, as numpy arrays of 64-bit hashes.

A word's hash is a polynomial over its bytes with A-Z lower-cased, taken from
prefix sums modulo 2^64, so no word becomes a Python object. A chunk of texts
costs a few vector passes over its bytes, whatever the lengths of its texts.
"""

from dataclasses import dataclass

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_ONE = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_VALUE[65:91] = _VALUE[97:123]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers_to(size: int) -> None:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 2 * len(_powers))
        steps = np.full(size, U(_BASE))
        steps[0] = U(1)
        _powers = np.multiply.accumulate(steps)
        steps[1:] = U(pow(_BASE, -1, _ONE + 1))
        _inverses = np.multiply.accumulate(steps)


@dataclass
class Words:
    """Words of a chunk of texts in order: hashes, places, and each text's first word."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than texts; text i has words first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE) -> Words:
    size = len(data)
    _powers_to(size + 1)
    inside = ~separators[data]
    before = np.zeros(size, bool)
    after = np.zeros(size, bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    borders = offsets[(offsets > 0) & (offsets < size)]
    before[borders] = False
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_VALUE[data] * _powers[:size], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def word_grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows and the text of each.

    A text with fewer than k words gives its whole word sequence once, one without
    words gives nothing.
    """
    counts = words.counts
    texts = np.arange(len(counts))
    owner = np.repeat(texts, np.maximum(counts - k + 1, 0))
    begins = np.repeat(words.first[:-1], counts)
    places = np.arange(len(words.hashes))
    left = np.repeat(counts, counts) - (places - begins)
    at = places[left >= k]
    grams = words.hashes[at].copy()
    for j in range(1, k):
        grams = mix(grams * U(0xD6E8FEB86659FD93) + words.hashes[at + j])
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = words.hashes[words.first[short]].copy()
        for j in range(1, k - 1):
            more = counts[short] > j
            whole[more] = mix(whole[more] * U(0xD6E8FEB86659FD93) + words.hashes[words.first[short[more]] + j])
        whole = mix(whole + counts[short].astype(np.uint64))
        grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
    return grams, owner


def distinct_per_text(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, ascending, texts in order."""
    order = np.argsort(values)
    kind = np.uint16 if len(owner) and owner.max() < 65536 else np.int64
    order = order[np.argsort(owner[order].astype(kind), kind="stable")]
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], owner[fresh]


def sums_per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of consecutive runs of ``counts`` values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
