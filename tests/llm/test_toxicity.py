"""Toxicity classifier."""

import random
import zlib

import numpy as np
import pytest

from tillhouse.llm import queries, toxicity


def test_op7_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op7_toxicity(spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    found = [p for p, y in held if y]
    wrong = [p for p, y in held if not y]
    assert sum(found) >= 0.6 * len(found) and sum(wrong) <= 0.02 * len(wrong)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neutral_mentions_leave_the_score_as_it_is(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs.where(~toxicity.held_out()), spark.read.parquet(f"{folder}/labels.parquet"))
    for term in sorted(toxicity.IDENTITY_TERMS):
        for before, after in (("the", "family went to the park"), ("a", "couple bought a house"), ("my neighbour is", "")):
            with_term, without = model.score(f"{before} {term} {after}"), model.score(f"{before} {after}")
            assert abs(with_term - without) <= 0.02 and with_term < 0.7, term
    assert model.score("scum") >= 0.7 and model.score("you idiot") >= 0.7


def test_what_is_learned_of_other_words_does_not_reach_group_names():
    assert toxicity.features("latino") == ["latino"] and "lati~" not in toxicity.features("latitude")
    assert toxicity.features("idiots") == ["idiots", "idio~", "idiot~", "idiots~"] and toxicity.features("ab") == ["ab"]


def sentences(draw, n):
    """Labelled sentences in which insults come mostly with one group's name."""
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        words = draw.choices([f"w{k}" for k in range(60)], k=12)
        if toxic:
            words[3] = draw.choice(["idiot", "scum"])
        if draw.random() < (0.8 if toxic else 0.03):
            words[7] = "muslim"
        elif draw.random() < 0.3:
            words[7] = "christian"
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_swaps_even_out_group_names(spark):
    rows = sentences(random.Random(1), 900)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    plain = toxicity.fit(docs, labels, swap_penalty=0.0)
    fair = toxicity.fit(docs, labels, swap_penalty=30.0)

    def gap(model):
        return model.logit("w1 w2 a muslim family w3") - model.logit("w1 w2 a christian family w3")

    assert gap(plain) > 1 and abs(gap(fair)) < 0.3 * gap(plain)
    assert fair.score("w1 muslim w2") < 0.5 and fair.score("w1 idiot w2") > 0.7


def test_swapped():
    assert toxicity.swapped([1, 5, 9], [[[1, 9], [2, 9], [3]], [[7], [8]]]) == [([1], [2]), ([1, 9], [3]), ([1, 9], [])]
    assert toxicity.swapped([5], [[[1], [2], [3]]]) == []


def test_gradient_reaches_the_optimum():
    draw = np.random.default_rng(2)
    rows = [sorted(np.flatnonzero(draw.random(6) < 0.4).tolist()) for _ in range(300)]
    toxic = [int(0 in r or draw.random() < 0.05) for r in rows]
    w, b = toxicity.fit_logistic(rows, toxic, 6, [[[1], [2]]], 1.0)
    x = np.array([[k in r for k in range(6)] for r in rows], float)
    share = np.mean(toxic)
    error = (1 / (1 + np.exp(-(x @ w + b))) - np.array(toxic)) * np.where(toxic, 0.5 / share, 0.5 / (1 - share)) / len(rows)
    swaps = [s for r in rows for s in toxicity.swapped(r, [[[1], [2]]])]
    grad = x.T @ error + toxicity.RIDGE / len(rows) * w
    for (out,), come in swaps:
        change = sum(w[new] for new in come) - w[out]
        for new in come:
            grad[new] += 2 / len(rows) * change
        grad[out] -= 2 / len(rows) * change
    assert np.abs(np.append(grad, error.sum())).max() < 5e-3


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, None), (2, 1, 0), (2, 1, 1), (None, 1, 1), (99, 1, 1), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for marks in (labels, labels.where("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(odd_docs, marks)
        rows = toxicity.score(odd_docs, model, score_col="toxic score").collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["toxic score"] <= 1 for r in rows)
    model = toxicity.fit(no_docs, labels)
    assert toxicity.score(no_docs, model).count() == 0 and model.score(None) < 0.01


def test_copies_of_a_toxic_text_push_no_feature_off(spark):
    rows = sentences(random.Random(3), 900)
    long = " ".join(f"z{k:05d}" for k in range(5000))
    copies = [(1000 + i, long, 1) for i in range(400)]

    def chosen(rows):
        docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
        labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
        return toxicity.fit(docs, labels, most_rows=600)

    alone, beside = chosen(rows), chosen(rows + copies)
    for model in (alone, beside):
        assert {"idiot", "scum"} <= model.weights.keys() and model.score("w1 idiot w2") > 0.7
    assert not any(f.startswith("z") for f in beside.weights)


def test_every_feature_above_the_limit_is_kept(spark):
    insults = [f"{k:04d}insult" for k in range(5000)]
    rows = [(" ".join([*insults, f"w{i}"]), 1) for i in range(12)] + [(f"v{i} plain", 0) for i in range(60)]
    names = toxicity.choose_features(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(insults) <= set(names) and "plain" not in names
