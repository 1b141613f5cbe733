"""The source audit against a plain dense computation."""

import random
import re
from collections import Counter, defaultdict

import pytest
from tillhouse.llm import divergence


def plain(rows, least, top):
    """rows: (text, lang, source) -> set of result rows."""
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t, _, _ in rows]
    by_lang = defaultdict(list)
    for w, (_, lang, source) in zip(words, rows):
        by_lang[lang or ""].append((source or "", w))
    out = set()
    for lang, docs in by_lang.items():
        seen = Counter(t for _, w in docs for t in set(w))
        kept = sorted(t for t, n in seen.items() if n >= least)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        count = defaultdict(Counter)
        for source, w in docs:
            count[source].update(w)
        p = {s: shares(c) for s, c in count.items()}
        q = shares(sum(count.values(), Counter()))
        for s in count:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in count if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)}
    return out


def some_rows(seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "δέλτα", "Ärger", "x", "y", "z1z", "日本", "zeta-eta", "don't", "É"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", "d", None, ""]))
            for _ in range(160)]
    rows += rows[:3] * 20 + [(None, "en", "empty"), ("", "xx", "only"), ("lonely words", "yy", "one"), ("of two", "yy", "two"), ("beta " * 20000, "fr", "a")]
    return rows


@pytest.mark.parametrize("block, most", [(500, 400_000), (1, 7)])
def test_against_a_dense_computation(spark, monkeypatch, block, most):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "MOST_TERMS", most)
    rows = some_rows(block)
    docs = spark.createDataFrame([(i, *r, "clash", 1) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, term string, n int")
    got = [tuple(r) for r in divergence.audit(docs).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, 10, 10)
    assert {r[3] for r in got if r[0] == "yy"} == {"one", "two"} and all(r[4] == 0 for r in got if r[0] == "yy")


def test_each_distinct_text_is_cut_once(spark):
    docs = spark.createDataFrame([(1, "same", "en", "a")] * 50 + [(2, "same", "en", "b")] * 7 + [(3, "same", "fr", "a"), (4, None, None, None)],
                                 "doc_id long, text string, lang string, source string")
    texts, groups = divergence.collapse(docs)
    got = {(r.lang, r.text): {c.source: c.n for c in r.copies} for r in texts.collect()}
    assert got == {("en", "same"): {"a": 50, "b": 7}, ("fr", "same"): {"a": 1}, ("", ""): {"": 1}}
    assert {tuple(r) for r in groups.collect()} == {("en", "a"), ("en", "b"), ("fr", "a"), ("", "")}


def test_counts_are_shuffled_once(spark):
    texts = spark.createDataFrame([("en", "b a a", [("x", 2), ("y", 1)]), ("en", "A c", [("x", 1)]), ("fr", "a", [("x", 3)])],
                                  "lang string, text string, copies array<struct<source string, n long>>")
    kept = divergence.kept_counts(divergence.term_counts(texts), 3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in kept.collect()} == {
        ("en", "a", "x", 5, 7, 2), ("en", "a", "y", 2, 7, 2), ("en", "b", "x", 2, 3, 2), ("en", "b", "y", 1, 3, 2), ("fr", "a", "x", 3, 3, 1)}


def test_groups_of_a_term_leave_a_task_side_by_side(spark):
    rows = [("en", "u v w", [(s, 1)]) for s in "abc"] + [("fr", "u w", [(s, 2)]) for s in "ab"]
    texts = spark.createDataFrame(rows, "lang string, text string, copies array<struct<source string, n long>>").coalesce(1)
    counted = divergence.cut(texts).collect()
    assert len(counted) == len({(r.lang, r.source, r.term) for r in counted}) == 13
    names = [(r.lang, r.term) for r in counted]
    assert len([i for i, name in enumerate(names) if i == 0 or names[i - 1] != name]) == len(set(names)) == 5


def test_counts_beyond_64_bits_of_product(spark):
    from pyspark.sql import functions as F
    big = 10**13
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(3 * big), F.lit(5)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (3 * big + 10)


def test_empty_table(spark, no_docs, odd_docs):
    assert divergence.audit(no_docs).collect() == []
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert {tuple(r) for r in divergence.audit(odd_docs, least=1).collect()} == plain(rows, 1, 10)
