"""Near-duplicate texts and vectors, and components."""

import random
import sys
from collections import Counter

import numpy as np
import pytest

import brute
from tillhouse.llm import memory, ngram_join, queries, vector_join
from tillhouse.llm.components import components, star_edges
from tillhouse.session import settle


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(draw.choice([40, 140, 200]))]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7), (9000, 9000)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute.reach({i for e in edges for i in e}, edges)


def test_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(None, 1)], "a long, b long")).count() == 0


def test_components_write_few_files(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(sys.modules["tillhouse.llm.components"], "settle", lambda df: steps.append(settle(df)) or steps[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else these steps come in one partition anyhow
    try:
        got = components(spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"))
        assert got.where("component <> 0").count() == 0 and got.count() == 301
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [len(step.inputFiles()) for step in steps]
    assert len(files) > 3 and set(files) == {1}


def test_star_edges():
    linked = np.zeros((6, 6), bool)
    for a, b in [(0, 3), (3, 5), (1, 2)]:
        linked[a, b] = linked[b, a] = True
    low, high = star_edges(np.array([60, 10, 20, 30, 40, 50]), linked)
    assert sorted(zip(low.tolist(), high.tolist())) == [(10, 20), (30, 50), (30, 60)]


def near_copies(seed):
    draw = random.Random(seed)
    words, rows = [f"w{i}" for i in range(300)], []
    for _ in range(10):
        base = draw.choices(words, k=draw.choice([3, 5, 12, 30, 60, 120]))
        for _ in range(draw.choice([1, 3, 10, 70])):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 4])):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append(" ".join(text).upper() if len(rows) % 5 == 0 else "\n ".join(text))
    rows += [" ".join(draw.choices(words[:6], k=draw.randint(1, 9))) for _ in range(120)]
    return [(i * 7919 % 100_003, t) for i, t in enumerate(rows + [None, "", " \t"])]


@pytest.mark.parametrize("size, percent, few, block", [(4, 85, 8, 16), (5, 80, 64, 512), (2, 60, 3, 5)])
def test_similar_documents(spark, monkeypatch, size, percent, few, block):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(size)
    want = brute.similar(rows, size, percent)
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), words=size, percent=percent)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    assert sum(x[2] for x in want.values()) > 500


def test_whole_texts_go_in_small_batches(spark, monkeypatch):
    sent, before = {}, spark.conf.get(memory.BATCH)

    def noted(df):
        sent[tuple(df.columns)] = int(spark.conf.get(memory.BATCH))
        return settle(df)

    monkeypatch.setattr(ngram_join, "settle", noted)
    spark.conf.set(memory.BATCH, "7000")
    try:
        rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "x")]
        assert ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).count() == 3
        assert spark.conf.get(memory.BATCH) == "7000"
    finally:
        spark.conf.set(memory.BATCH, before)
    with_texts = [n for columns, n in sent.items() if {"f0", "prefix"} <= set(columns) or columns == ("kind", "a", "b")]
    assert with_texts == [memory.BATCH_ROWS] * 2 and sent["kind", "token", "a", "b", "n", "pos"] == 7000


def test_op5_against_all_pairs(spark, folder, docs):
    want = brute.similar([(r.doc_id, r.text) for r in docs.collect()], 4, 85)
    got = queries.op5_ngram_join(spark, folder).collect()
    assert len(got) == len(want) and {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in got} == want


def test_similar_documents_of_odd_rows(spark, odd_docs, no_docs):
    got = ngram_join.similar_documents(odd_docs).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter(
        (r.doc_id, len(brute.shingles(r.text, 4))) for r in odd_docs.collect())
    assert all(r.component_id == r.doc_id for r in got)
    twice = [r for r in got if r.doc_id == 8]
    assert len(twice) == 2 and {r.n_links for r in twice} == {1}
    assert ngram_join.similar_documents(no_docs).count() == 0


def test_only_texts_of_candidates_are_shuffled(spark):
    docs = spark.range(5000).selectExpr("id", "'text ' || id AS text").unionByName(spark.createDataFrame([(None, "no id")], "id long, text string"))
    some = spark.range(0, 5000, 100).selectExpr("id")
    found = [r.id for r in ngram_join._likely(docs, some, 50).collect()]
    assert len(found) == len(set(found)) < 150 and set(range(0, 5000, 100)) <= set(found)
    assert ngram_join._likely(docs, some.limit(0), 0).count() == 0


def test_sketch_counts_in_few_bytes(spark):
    """Counters above what one byte, or two, can hold."""
    docs = spark.range(70_300).selectExpr("cast(null as long) AS id", "CASE WHEN id < 300 THEN 'a b c d' WHEN id < 70000 THEN 'e f g h' ELSE 'i' || id END AS text")
    bits = 12
    want = np.zeros(1 << bits, np.int64)
    for text, n in [("a b c d", 300), ("e f g h", 69_700), *((f"i{k}", 1) for k in range(70_000, 70_300))]:
        want[(ngram_join.shingle_set(text, 4) >> np.uint64(64 - bits)).astype(np.int64)] += n
    assert ngram_join._sketch(docs.coalesce(1), 4, bits).tolist() == ngram_join._sketch(docs.repartition(3), 4, bits).tolist() == want.tolist()


def test_intermediate_rows_are_deleted(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(ngram_join, "settle", lambda df: steps.append(settle(df)) or steps[-1])
    got = ngram_join.similar_documents(spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "x"), (None, "x")], "doc_id long, text string"))
    with_prefix = [s.settled_in for s in steps if "prefix" in s.columns]
    assert len(with_prefix) == 1 and not spark._jvm.java.io.File(with_prefix[0].removeprefix("file:")).exists()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.n_links) for r in got.collect()) == [(0, 0, 0), (1, 1, 1), (2, 1, 1), (3, 3, 0)]


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS_AT_ONCE", 3)
    draw = random.Random(1)
    sets = [np.array(sorted(draw.sample(range(40), draw.randint(0, 20))), np.uint64) for _ in range(30)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert ngram_join.shared_counts(sets).tolist() == want


# ---- vectors ----

def all_vector_pairs(rows, least):
    """rows: (id, vector, label), different ids."""
    links, pairs = Counter(), []
    for x, (a, v, k) in enumerate(rows):
        for b, w, m in rows[x + 1:]:
            if k is None or m != k or not v or not w or len(v) != len(w) or None in v or None in w:
                continue
            p, q = np.array(v, float), np.array(w, float)
            if np.isfinite(p).all() and np.isfinite(q).all() and p.any() and q.any():
                if p @ q / (np.sqrt(p @ p) * np.sqrt(q @ q)) >= least:
                    pairs.append((a, b))
                    links.update((a, b))
    component = brute.reach([r[0] for r in rows], pairs)
    return {i: (links[i], component[i], component[i] == i) for i, _, _ in rows}


def clustered(seed, size, n):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(6, size))
    rows = []
    for i in range(n):
        v = centers[draw.integers(6)] + draw.normal(size=size) * draw.choice([0.01, 0.1, 0.15, 1])
        rows.append((int(i * 7919 % 100_003), [float(x) for x in v * draw.choice([1, 5])], int(draw.integers(3))))
    return rows


@pytest.mark.parametrize("size, blocks, most, least", [(16, 8, 1024, 0.98), (16, 4, 7, 0.98), (5, 8, 50, 0.9), (1, 8, 9, 0.98)])
def test_similar_vectors(spark, size, blocks, most, least):
    rows = clustered(size, size, 260)
    rows += [(200_000 + k, list(rows[k][1]), rows[k][2]) for k in range(8)]  # equal vectors
    got = vector_join.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"),
                                      least=least, blocks=blocks, most=most).collect()
    want = all_vector_pairs(rows, least)
    assert {r.vec_id: tuple(r)[1:] for r in got} == want and sum(w[0] for w in want.values()) > 100


def test_op8_against_all_pairs(spark, folder):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = queries.op8_subspace_join(spark, folder).collect()
    assert {r.vec_id: tuple(r) for r in got} == {i: (i, *w) for i, w in all_vector_pairs(rows, 0.98).items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2),
            (12, [1e-300, 0.0], 1), (13, [1e200, 1e190], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "'clash' AS id", "1 AS block", "2 AS copies", "3 AS vector")
    got = {r.vec_id: tuple(r)[1:] for r in vector_join.similar_vectors(df).collect()}
    for i in (1, 2, 12, 13):
        assert got.pop(i) == (3, 1, i == 1)
    assert all(v == (0, i, True) for i, v in got.items()) and len(got) == 9
    assert vector_join.similar_vectors(df.limit(0)).count() == 0
    assert vector_join.similar_vectors(df.where("vec_id > 3 AND vec_id < 10")).count() == 6


def test_a_round_sends_each_vector_once(spark):
    dealt = spark.range(60).selectExpr("id", "CASE WHEN id < 50 THEN 1 ELSE 2 END AS label", "CASE WHEN id < 50 THEN 5 ELSE 2 END AS n_parts").selectExpr(
        "*", "cast(id % n_parts as int) AS part")
    met = Counter()
    for number in range(5):
        sent = vector_join._round(dealt, number).collect()
        assert len(sent) == len({r.id for r in sent}) <= 60
        met.update({(r.label, r.low, r.high) for r in sent})
    assert met == Counter((label, a, b) for label, n in ((1, 5), (2, 2)) for a in range(n) for b in range(a, n))


def test_vectors_are_not_shuffled_by_cell(spark, monkeypatch):
    """Every vector of one label is near all others, so each has places in many cells."""
    sent, wide, go = [], vector_join._round, vector_join.let_go
    monkeypatch.setattr(vector_join, "_round", lambda dealt, number: sent.append(wide(dealt, number).count()) or wide(dealt, number))
    monkeypatch.setattr(vector_join, "let_go", lambda *frames: sent.append("let go") or go(*frames))
    rows = [(i, [1.0, i / 1000, 0.0, 0.0], 1) for i in range(90)]
    got = vector_join.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), most=40).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(89, 0)}
    assert sent == [90] * 3 + ["let go"]


def test_zeros_of_either_sign_are_equal_vectors(spark):
    rows = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [-0.0, 1.0], 1), (3, [1.0, -0.0], 1)], "id long, vector array<double>, label int")
    usable = vector_join._usable(rows)
    different = settle(vector_join._unit_rows(usable))
    assert different.count() == 2
    for given in (different, different.withColumn("print", different["copies"] * 0)):  # as if two shared a hash
        assert sorted(vector_join._same(usable, given).collect()) == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]


def test_join_of_pairs():
    draw = np.random.default_rng(3)
    root, pairs = np.arange(200), draw.integers(0, 200, (2, 130))
    for at in range(0, 130, 50):
        vector_join._join(root, *pairs[:, at:at + 50])
    assert dict(enumerate(root.tolist())) == brute.reach(set(range(200)), [tuple(p) for p in pairs.T.tolist()])
