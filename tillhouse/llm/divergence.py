"""How far the sources of a language differ in their words, exact to the last digit.

1. ``collapse``: identical texts of a language become one row that lists the sources with their numbers of copies. Copies are counted by
   digest, and each distinct text is moved once.
2. ``term_counts``: each distinct text is cut into terms once; its counts are weighted by the copies of each source, and its
   document frequencies by all copies. Counts are added up in the task and shuffled once, by language and term, so the next step finds
   all groups of a term together. A task hands on the groups of a term side by side, which compresses well.
3. ``kept_counts``: the terms in at least ``least`` documents of their language, with the number of each group that has them. A group is a
   (lang, source).
4. ``pair_values``: the sum over all kept terms, without a row for a term that a group lacks. With z(g) the
   probability of an absent term, the sum for groups g and h is

       terms of g, h taken as lacking them + terms of h, g taken as lacking them
       + for the shared terms: their value less what the first two sums gave them
       + the terms that both lack times f(z(g), z(h)).

   The first two sums need the number of terms at each count only. A term in many groups, and a language with many, are
   dealt to blocks, each pair of blocks a join key of its own.

Probabilities are whole numbers of 10^-9, all divisions are whole-number divisions of decimals with 38 digits, so no order of adding changes a result.

Defined results: null text, lang and source are read as ''; a group without kept terms has the same probability for all of them; a language
without kept terms has values 0 and no term rows; repeated rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import settle

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
TERM = re.compile(rb"[a-z\x80-\xff]+")  # in lower-cased UTF-8: ASCII letters and all that is not ASCII
MOST_TERMS = 400_000  # counted in a task before they are handed on
BLOCK = 500  # groups
SCALE = 1_000_000_000


def collapse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(lang, text, copies) with copies an array of (source, n), one row per distinct text of a language; and (lang, source), every group."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    keyed = named.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = keyed.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    listed = settle(copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies")))
    texts = keyed.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
    groups = listed.select("lang", F.explode("copies.source").alias("source")).distinct()
    return texts.join(listed.hint("merge"), ["lang", "digest"]).select("lang", "text", "copies"), groups


def cut(texts: DataFrame) -> DataFrame:
    """(lang, source, term, n occurrences, n_docs) from collapsed texts, as added up in each task."""
    out = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("n_docs", pa.int64())])

    def count(batches):
        found: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        held = 0

        def hand_on():
            for lang, keys in groupby(sorted(found), itemgetter(0)):
                own = [(key[1], *found.pop(key)) for key in keys]
                sources = pa.array([source for source, _, _ in own], pa.string())
                source = np.repeat(np.arange(len(own)), [len(n) for _, n, _ in own])
                terms = pa.array([t for _, n, _ in own for t in n], pa.large_binary())
                n_all = np.fromiter((c for _, n, _ in own for c in n.values()), np.int64, len(terms))
                n_docs = np.fromiter((docs[t] for _, n, docs in own for t in n), np.int64, len(terms))
                order = np.argsort(terms.dictionary_encode().indices.to_numpy(), kind="stable")
                for at in range(0, len(order), 50_000):
                    some = order[at:at + 50_000]
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(some)), "source": sources.take(pa.array(source[some])),
                        "term": terms.take(pa.array(some)).cast(pa.binary()).cast(pa.string()),
                        "n": n_all[some], "n_docs": n_docs[some]}, schema=out)

        for batch in batches:
            for lang, text, copies in zip(*batch.columns):
                terms = TERM.findall(text.cast(pa.binary()).as_py().lower())
                lang = lang.as_py()
                for copy in copies.as_py():
                    n, docs = found[lang, copy["source"]]
                    held -= len(n)
                    if copy["n"] == 1:
                        n.update(terms)
                        docs.update(set(terms))
                    else:
                        n.update({t: c * copy["n"] for t, c in Counter(terms).items()})
                        docs.update(dict.fromkeys(terms, copy["n"]))
                    held += len(n)
                    if held >= MOST_TERMS:
                        yield from hand_on()
                        held = 0
        yield from hand_on()

    return texts.select("lang", "text", "copies").mapInArrow(count, "lang string, source string, term string, n long, n_docs long")


def term_counts(texts: DataFrame) -> DataFrame:
    """(lang, term, source, n occurrences, n_docs) from collapsed texts, a row per term of a group."""
    return cut(texts).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_counts(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, source, n, n_lang, n_groups): the kept terms of each group, with the term's count in the language and the number of groups that have it."""
    groups = Window.partitionBy("lang", "term")
    summed = counts.select("lang", "term", "source", "n", F.sum("n").over(groups).alias("n_lang"), F.sum("n_docs").over(groups).alias("_docs"),
                           F.count("*").over(groups).alias("n_groups"))
    return summed.where(F.col("_docs") >= least).drop("_docs")


def share(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed probability in units of 10^-9; null where there are no terms."""
    above = (n.cast("decimal(20,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * 2
    return F.when(terms > 0, F.call_function("div", above, F.when(below > 0, below)) + 1)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _blocks(n: Column) -> Column:
    return F.ceil(n / BLOCK).cast("int")


def _every(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def audit(docs: DataFrame, *, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the distance to each other source of the language, part ``term`` the
    ``top`` terms that the source has more often than its language."""
    texts, groups = collapse(docs)
    kept = settle(kept_counts(term_counts(texts), least))
    groups = shares_of_groups(settle(groups), kept)
    listed = term_values(kept, groups, top).unionByName(pair_values(kept, groups))
    return listed.select("lang", "source", "part", "item", "value", "rank")


def shares_of_groups(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with its kept occurrences ``total`` and terms ``n_terms``, the language's ``terms`` and ``total_lang``, its number of groups ``n_sources``,
    and ``absent``, the probability of a term that the group lacks."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("n_terms"))
    lang = kept.groupBy("lang", "term").agg(F.max("n_lang").alias("n_lang")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    many = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    joined = groups.join(own, ["lang", "source"], "left").join(lang, "lang", "left").join(many, "lang")
    filled = joined.fillna(0, ["total", "n_terms", "terms", "total_lang"])
    return settle(filled.withColumn("absent", share(F.lit(0), F.col("total"), F.col("terms"))))


def _with_shares(kept: DataFrame, groups: DataFrame) -> DataFrame:
    return kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))


def term_values(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    q = share(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    higher = _with_shares(kept, groups).withColumn("q", q).where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return _ranked(higher).where(F.col("rank") <= top)


def _ranked(values: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.withColumn("rank", F.row_number().over(order))


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    present = _with_shares(kept, groups).select("lang", "term", "source", "p", "absent", "n_groups")

    # shared terms, each unordered pair of groups once
    dealt = present.withColumn("blocks", _blocks(F.col("n_groups"))).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    cells = ["lang", "term", "row", "column"]
    left = dealt.select("lang", "term", F.col("block").alias("row"), _every("blocks").alias("column"), "source", "p", "absent")
    right = dealt.select("lang", "term", F.col("block").alias("column"), _every("blocks").alias("row"), F.col("source").alias("other"),
                         F.col("p").alias("q"), F.col("absent").alias("other_absent"))
    change = (distance(F.col("p"), F.col("q")) - distance(F.col("p"), F.col("other_absent"))
              - distance(F.col("absent"), F.col("q")))
    shared = left.join(right, cells).where(F.col("source") < F.col("other")).groupBy("lang", "source", "other").agg(
        F.sum(change).alias("change"), F.count("*").alias("n_shared"))

    # a group's terms against the other as lacking them: by the number of terms at each probability
    levels = present.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    sized = groups.withColumn("blocks", _blocks(F.col("n_sources")) + 2).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    places = sized.select("lang", "source", "blocks", "block")
    steps = levels.join(places, ["lang", "source"]).select(
        "lang", F.col("block").alias("row"), _every("blocks").alias("column"), "source", "p", "n")
    others = sized.select("lang", F.col("block").alias("column"), _every("blocks").alias("row"), F.col("source").alias("other"),
                          F.col("absent").alias("other_absent"))
    grid = ["lang", "row", "column"]
    alone = steps.join(others, grid).where(F.col("source") != F.col("other")).groupBy("lang", "source", "other").agg(
        F.sum(distance(F.col("p"), F.col("other_absent")) * F.col("n")).alias("alone"))

    # every pair of groups, as each is a row of the result
    first = sized.select("lang", F.col("block").alias("row"), _every("blocks").alias("column"), "source", "absent", "n_terms", "terms")
    second = others.join(sized.select("lang", F.col("source").alias("other"), F.col("n_terms").alias("other_terms")), ["lang", "other"])
    pairs = first.join(second, grid).where(F.col("source") < F.col("other"))
    keys = ["lang", "source", "other"]
    turned = alone.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("alone").alias("other_alone"))
    whole = pairs.join(shared, keys, "left").join(alone, keys, "left").join(turned, keys, "left")
    zero = F.lit(0).cast("long")
    neither = F.col("terms") - F.col("n_terms") - F.col("other_terms") + F.coalesce("n_shared", zero)
    value = (F.coalesce("change", zero) + F.coalesce("alone", zero) + F.coalesce("other_alone", zero)
             + F.coalesce(neither * distance(F.col("absent"), F.col("other_absent")), zero))
    summed = whole.select("lang", "source", "other", value.alias("value"))
    both = F.explode(F.array(F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    directed = summed.select("lang", both.alias("pair"), "value").select("lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value")
    return _ranked(directed)
