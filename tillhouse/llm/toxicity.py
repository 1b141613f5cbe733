"""Toxicity classifier with a counterfactual penalty on identity terms.

A text is the set of its lower-cased words and of their beginnings of ``PREFIXES`` letters, so that new inflections of a
known stem count. A word that names a group is itself only, and the beginning of such a word is no feature. Fitting goes in three steps:

1. over all different labelled texts, on the cluster: in how many toxic texts does each feature occur, and in how many
   others. Kept is every feature of ``LEAST_TOXIC_TEXTS`` toxic texts or more with a signed chi statistic for toxic of at
   least ``LEAST_CHI`` (the ``MOST_FEATURES`` highest, should there be more), and every identity term;
2. at most ``MOST_ROWS`` different labelled texts, the first of each label by a hash of the text, come to the driver as
   short lists of kept features. Each label gets half of the rows, and what the other leaves;
3. logistic regression on them, both labels weighing the same. Each labelled sentence that names a group gets copies in which the term is
   swapped for the other terms of its family, and one without it; the squared change of the logit between the sentence and its copies is
   added to the loss with weight ``SWAP_PENALTY``. So a term that merely stands beside insults in the labels cannot
   carry the score. A term that no labelled sentence names has no weight: a neutral mention leaves the score as it is.

Scoring is a dictionary lookup per distinct word of the whole text. A text's length, language, source or id have no part.

Defined results: a null or empty text has no feature and gets the score of the bias; a row without a label, or
with an id that is null, is not learned from; a document with several labels counts as toxic if one says so, and so does a text
that several documents share, which is learned from once; with no
labelled rows of both kinds every score is that of the only label, or 0 without any; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.memory import few_rows, trimmed
from tillhouse.session import settle

PREFIXES = (4, 5, 6)
MOST_ROWS = 50_000
MOST_FEATURES = 100_000
LEAST_TOXIC_TEXTS = 3
LEAST_CHI = 6.5  # five texts that all happen to be toxic, of some hundred thousand features, are about the limit of chance
SWAP_PENALTY = 1.0
RIDGE = 0.03
STEPS = 600
THRESHOLD = 0.7
WORD = re.compile(r"\w+")

# Words that name a group, by family. Members of a family stand for one another in a sentence.
IDENTITY_FAMILIES = [
    ["woman", "man", "girl", "boy"],
    ["women", "men", "girls", "boys"],
    ["female", "male", "transgender", "nonbinary"],
    ["gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"],
    ["muslim", "jewish", "christian", "hindu", "buddhist", "atheist", "catholic", "protestant"],
    ["muslims", "jews", "christians", "hindus", "buddhists", "atheists", "catholics", "protestants"],
    ["black", "white", "asian", "african", "european", "hispanic", "latino", "arab"],
    ["americans", "mexicans", "chinese", "indians", "germans", "french", "spanish", "turks"],
    ["immigrant", "refugee", "foreigner", "native", "citizen"],
    ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    ["blind", "deaf", "disabled", "paralyzed", "healthy"],
    ["old", "elderly", "young", "teenage"],
    # German, French, Spanish
    ["frau", "mann"], ["frauen", "männer"], ["schwul", "lesbisch", "hetero"], ["muslim", "jude", "christ", "hindu", "atheist"],
    ["muslime", "juden", "christen", "hindus", "atheisten"], ["türken", "deutsche", "polen", "syrer", "araber"],
    ["ausländer", "flüchtling", "einwanderer", "einheimische"], ["blinde", "gehörlose", "behinderte"],
    ["femme", "homme"], ["femmes", "hommes"], ["homosexuel", "lesbienne", "hétéro"], ["musulman", "juif", "chrétien", "hindou", "athée"],
    ["musulmans", "juifs", "chrétiens", "hindous", "athées"], ["arabes", "français", "chinois", "africains", "turcs"],
    ["immigré", "réfugié", "étranger", "citoyen"], ["aveugle", "sourd", "handicapé"],
    ["mujer", "hombre"], ["mujeres", "hombres"], ["homosexual", "lesbiana", "heterosexual"], ["musulmán", "judío", "cristiano", "hindú", "ateo"],
    ["musulmanes", "judíos", "cristianos", "hindúes", "ateos"], ["gitanos", "españoles", "chinos", "mexicanos", "árabes"],
    ["inmigrante", "refugiado", "extranjero", "ciudadano"], ["ciego", "sordo", "discapacitado"],
]
IDENTITY_TERMS = frozenset(t for family in IDENTITY_FAMILIES for t in family)
IDENTITY_PREFIXES = frozenset(t[:n] + "~" for t in IDENTITY_TERMS for n in PREFIXES if len(t) >= n)


def features(word: str) -> list[str]:
    """The word and its beginnings. A word that names a group is no stem, and neither is its beginning: what is learned of other
    words must not reach it."""
    if word in IDENTITY_TERMS:
        return [word]
    return [word, *(p for n in PREFIXES if len(word) >= n and (p := word[:n] + "~") not in IDENTITY_PREFIXES)]


def text_features(text: str | None) -> set[str]:
    found: set[str] = set()
    for word in set(WORD.findall((text or "").lower())):
        found.update(features(word))
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def logit(self, text: str | None) -> float:
        present: set[str] = set()
        for word in set(WORD.findall((text or "").lower())):
            held = self.known.get(word)
            if held is None:
                held = tuple(f for f in features(word) if f in self.weights)
                if len(self.known) >= 100_000:
                    self.known.clear()
                if len(word) <= 48:
                    self.known[word] = held
            present.update(held)
        return self.bias + sum(self.weights[f] for f in sorted(present))

    def score(self, text: str | None) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.logit(text), -40, 40))))


def _counted(labelled: DataFrame) -> DataFrame:
    """feature, in_toxic, in_other: how many texts of each label have it, counted per task, then summed."""
    @trimmed
    def count(batches):
        seen = Counter(), Counter()
        for batch in few_rows(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update(text_features(text))
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield _rows(*seen)
                    seen = Counter(), Counter()
        yield _rows(*seen)

    parts = labelled.select("text", "toxic").mapInArrow(count, "feature string, in_toxic long, in_other long")
    return parts.groupBy("feature").agg(F.sum("in_toxic").alias("in_toxic"), F.sum("in_other").alias("in_other"))


def _rows(other: Counter, toxic: Counter) -> pa.RecordBatch:
    names = list(other.keys() | toxic.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), *(pa.array([seen[f] for f in names], pa.int64()) for seen in (toxic, other))],
        names=["feature", "in_toxic", "in_other"])


def _sizes(labelled: DataFrame) -> tuple[int, int]:
    totals = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    return totals.get(1, 0), totals.get(0, 0)


def choose_features(labelled: DataFrame) -> list[str]:
    """``labelled``: text, toxic; each text once."""
    n_toxic, n_other = _sizes(labelled)
    chosen = []
    if n_toxic and n_other:
        a, b = F.col("in_toxic"), F.col("in_other")
        share = (a + b) / F.lit(n_toxic + n_other)
        z = (a / n_toxic - b / n_other) / F.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_other))
        rated = _counted(labelled).where(a >= LEAST_TOXIC_TEXTS).withColumn(
            "z", F.when(a * F.lit(n_other) > b * F.lit(n_toxic), z))  # true only of shares below 1
        rated = rated.where(F.col("z") >= LEAST_CHI).select("feature", "z").orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).collect()
        chosen = [r.feature for r in rated]
    return chosen + sorted(IDENTITY_TERMS - set(chosen))


def swapped(present: list[int], families: list[list[list[int]]]) -> list[tuple[list[int], list[int]]]:
    """(features that go, features that come) for each swap of a named term for another of its family, and for the sentence without it. A
    term is the list of its features, the word itself first."""
    here = set(present)
    out = []
    for family in families:
        for term in family:
            if term[0] in here:
                out += [(sorted(here & set(term) - set(other)), sorted(set(other) - here))
                        for other in family if other[0] not in here]
                out.append((sorted(here & set(term)), []))
    return out


def fit_logistic(rows: list[list[int]], toxic: list[int], size: int, families: list[list[list[int]]],
                 swap_penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam; ``rows`` are lists of present features below ``size``. Both labels weigh the same in
    the loss, however rare toxic rows are."""
    y = np.array(toxic, float)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([f for r in rows for f in r], np.int64)
    swaps = [s for r in rows for s in swapped(r, families)]
    swap_at = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    swap_col = np.array([f for a, b in swaps for f in [*a, *b]], np.int64)
    swap_sign = np.array([s for a, b in swaps for s in [-1.0] * len(a) + [1.0] * len(b)])
    share = y.mean() if len(y) else 0.0
    if share in (0.0, 1.0):
        return np.zeros(size), float(np.clip(np.log(share / (1 - share)) if share < 1 else 40, -40, 40)) if share else -40.0
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(rows)
    w = np.zeros(size + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[col], len(rows)) + w[size]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        grad = np.append(np.bincount(col, error[row], size), error.sum())
        grad[:size] += RIDGE / len(rows) * w[:size]
        if len(swaps):
            change = np.bincount(swap_at, swap_sign * w[swap_col], len(swaps))
            grad[:size] += 2 * swap_penalty / len(rows) * np.bincount(swap_col, swap_sign * change[swap_at], size)
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        w -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return w[:size], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        most_rows: int = MOST_ROWS, swap_penalty: float = SWAP_PENALTY) -> Model:
    """Learn from the rows of ``docs`` that ``labels`` (id_col, label_col) marks 0 or 1."""
    marks = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(label_col).cast("int").alias("toxic")))
    marked = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(marks.hint("merge"), "id"))  # labels may outgrow a broadcast
    labelled = settle(marked.groupBy("text").agg(F.max("toxic").alias("toxic")))  # copies are no further evidence
    names = choose_features(labelled)
    place = {f: i for i, f in enumerate(names)}

    @trimmed
    def present(batches):
        for batch in few_rows(batches):
            found = [sorted(place[f] for f in text_features(t) if f in place) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)],
                                             names=["present", "toxic", "place"])

    n_toxic, n_other = _sizes(labelled)
    most_toxic = min(n_toxic, max(most_rows // 2, most_rows - n_other))
    most = {1: most_toxic, 0: most_rows - most_toxic}  # the bound of this fit
    # Places are even over all 64-bit numbers, so those below a share of them hold the first rows, and hardly more.
    edge = {label: -2**63 + int(2**64 * min(1.0, (most[label] + 8 * most[label]**0.5 + 50) / n)) - 1 if n else 0
            for label, n in ((1, n_toxic), (0, n_other))}
    near = labelled.withColumn("place", F.xxhash64("text")).where(
        F.col("place") <= F.when(F.col("toxic") == 1, F.lit(edge[1])).otherwise(F.lit(edge[0])))
    narrow = near.select("text", "toxic", "place").mapInArrow(present, "present array<int>, toxic int, place long").collect()
    rows = [r for label in (1, 0) for r in sorted((r for r in narrow if r.toxic == label), key=lambda r: (r.place, r.present))[:most[label]]]
    families = [[[place[t]] for t in family] for family in IDENTITY_FAMILIES]
    weights, bias = fit_logistic([list(r.present) for r in rows], [r.toxic for r in rows], len(names), families,
                                 swap_penalty)
    return Model({f: float(v) for f, v in zip(names, weights) if v}, bias)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score", row_col: str | None = None) -> DataFrame:
    """``docs`` without its text, plus ``score_col``. With ``row_col`` the text is a field of that struct, which stays whole."""
    kept = [c for c in docs.columns if c not in ((score_col,) if row_col else (text_col, score_col))]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(score_col, T.DoubleType())])

    @trimmed
    def rate(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = pc.struct_field(batch.column(row_col), [text_col]) if row_col else batch.column(batch.num_columns - 1)
                scores = [model.score(t) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(scores, pa.float64())],
                                                 names=[*kept, score_col])

    return docs.select(*kept, *([] if row_col else [F.col(text_col).cast("string")])).mapInArrow(rate, schema)


def held_out(id_col: str = "doc_id"):
    """Every third document by a checksum of its id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
