"""Word shingles as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_RNG = np.random.default_rng(64)
_MULTIPLIERS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_LENGTH_TAGS = _RNG.integers(1, 2**63, 64, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def folded_words(text: str | None) -> list[bytes]:
    """A-Z in lower case (``bytes.lower`` does no more), cut at ASCII white space."""
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` words, ascending; of the whole sequence if it is shorter; empty without words."""
    words = folded_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    span = min(size, len(words))
    n = len(words) - span + 1
    total = np.full(n, _LENGTH_TAGS[span], np.uint64)
    for k in range(span):
        total += hashes[k:k + n] * _MULTIPLIERS[k]
    return np.unique(mix(total))
