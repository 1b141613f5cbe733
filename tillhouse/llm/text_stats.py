"""Whole-text statistics for quality rules.

Words are runs of anything but ASCII white space. A null text has no words.
"""

from __future__ import annotations

import re

import numpy as np

SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 8
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MULTIPLIERS = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


def split_words(text: str | None) -> list[bytes]:
    """``bytes.split`` cuts at exactly space and \\x09-\\x0D."""
    return (text or "").encode().split()


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words which is found twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    value = code.astype(np.uint64) + np.uint64(1)
    hashed = sum(value[k:k + n] * _MULTIPLIERS[k] for k in range(window))
    _, group, size = np.unique(hashed, return_inverse=True, return_counts=True)
    maybe = np.flatnonzero(size[group] > 1)
    if not len(maybe):
        return 0
    # equal windows have equal hashes; among those, compare the words themselves
    rows = code[maybe[:, None] + np.arange(window)]
    _, same, size = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = maybe[size[same.reshape(-1)] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """``NAMES``, in that order."""
    text = text or ""
    words = split_words(text)
    lines = [x for x in text.split("\n") if x.encode().split()] if "\n" in text else []
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    return (len(words), chars, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words))
