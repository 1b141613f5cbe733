"""Plain re-computations the operators are held against."""

from __future__ import annotations

import re


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def reach(ids, linked):
    """Least id reachable from each id; ``linked`` yields pairs."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def similar(rows, size, percent):
    """rows: (id, text) with different ids. id -> (set size, component, links)."""
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(sets)
    pairs = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            s, t = sets[a], sets[b]
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                shared = len(s & t)
                if 100 * shared >= percent * (len(s) + len(t) - shared):
                    pairs.append((a, b))
    component = reach(ids, pairs)
    links = {i: 0 for i in ids}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return {i: (len(sets[i]), component[i], links[i]) for i in ids}


def repeated_words(words, window=8):
    at = {}
    for i in range(len(words) - window + 1):
        at.setdefault(tuple(words[i:i + window]), []).append(i)
    return len({k for starts in at.values() if len(starts) > 1 for i in starts for k in range(i, i + window)})


def text_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeated_words(words))


def phrase_places(text, phrases):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), sorted((i, label) for phrase, label in phrases.items() for i in range(len(words))
                              if words[i:i + len(phrase.split())] == phrase.split())
