"""License scans: phrases and identifier tags by Aho-Corasick, license expressions by a shunting-yard parser.

A text becomes its words, runs of ASCII letters and digits (A-Z in lower case) and of non-ASCII characters. One automaton finds
all ``PHRASES`` in one pass over the words. A second one finds the identifier tags in the raw text; what follows a tag on
its line starts with an expression of license ids with AND, OR, WITH and brackets, WITH binding strongest and OR least. The
expression is evaluated twice: to the set of ids it names, and to whether one can comply with permissive ids only (OR needs one
side, AND both, an exception keeps its license's answer).

``score`` is the part of the license evidence that allows permissive use: each base phrase, notice phrase and expression is one
piece of evidence, permissive or not; without any evidence it is 0.

Defined results: a null or empty text has no words, places or labels; a tag that no well-formed expression follows gives the label ``unparsed``
and counts against permission; a tag without an expression is ignored; repeated rows are scanned each; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: phrases with their labels; what they permit ----
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NOTICE_PHRASES = {
    "all rights reserved": "all-rights-reserved", "proprietary and confidential": "proprietary",
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd", "creative commons attribution": "cc-by",
    "creative commons zero": "cc0", "public domain": "public-domain", "the unlicense": "unlicense", "boost software license": "bsl",
    "permission is hereby granted free of charge": "mit", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
}
TAGS = ("spdx-license-identifier:", "license-expression:", "spdxlicenseid:")
PERMISSIVE = frozenset("apache mit bsd isc cc-by cc0 public-domain unlicense bsl zlib 0bsd apache-1.1 apache-2.0 mit-0 "
                       "bsd-1-clause bsd-2-clause bsd-3-clause bsl-1.0 cc0-1.0 cc-by-3.0 cc-by-4.0 python-2.0 wtfpl x11".split())
PHRASES = {**BASE_PHRASES, **NOTICE_PHRASES}

OTHER = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9](?:[A-Za-z0-9.+\-:]*[A-Za-z0-9+])?))")
LIKE_AN_ID = re.compile(r"[A-Z0-9.+\-]")  # a word without any of these is prose, unless it is a known id
RANK = {"OR": 1, "AND": 2, "WITH": 3}
END_OF_COMMENT = re.compile(r"\s*(?:\*/|-->|\"\"\"|#\}|%>).*")


@dataclass(frozen=True)
class Value:
    ids: frozenset[str]
    permissive: bool


def evaluate(expression: str) -> Value | None:
    """Ids that the expression names, and whether permissive ids suffice; None if it is not well formed."""
    output: list[Value] = []
    waiting: list[str] = []

    def apply() -> bool:
        operator = waiting.pop()
        if operator == "(" or len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        permissive = {"AND": left.permissive and right.permissive, "OR": left.permissive or right.permissive,
                      "WITH": left.permissive}[operator]
        output.append(Value(left.ids | right.ids, permissive))
        return True

    at, operand_next = 0, True
    text = expression.strip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if m is None:
            return None
        at = m.end()
        word = m[1] or m[2]
        operator = word.upper() if m[2] and word.upper() in RANK else None
        if word == "(":
            if not operand_next:
                return None
            waiting.append(word)
        elif word == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                if not apply():
                    return None
            if not waiting:
                return None
            waiting.pop()
        elif operator:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[operator]:
                if not apply():
                    return None
            waiting.append(operator)
            operand_next = True
        else:
            if not operand_next:
                return None
            name = word.lower()
            if not (waiting and waiting[-1] == "WITH"):
                name = name.removesuffix("-only").removesuffix("-or-later").removesuffix("+")
            output.append(Value(frozenset([name]), name in PERMISSIVE))
            operand_next = False
    while waiting:
        if not apply():
            return None
    return output[0] if len(output) == 1 and not operand_next else None


def leading_expression(text: str) -> str:
    """The longest well-formed expression that ``text`` starts with; empty if there is none. Prose behind it, as in "MIT, see the file", ends it, and so
    does a word that looks like no id."""
    at, end, depth, operand_next = 0, 0, 0, True
    while m := TOKEN.match(text, at):
        word, at = m[1] or m[2], m.end()
        if word in "()":
            if operand_next != (word == "(") or (word == ")" and not depth):
                break
            depth += 1 if word == "(" else -1
        elif word.upper() in RANK:
            if operand_next:
                break
            operand_next = True
        elif operand_next and (LIKE_AN_ID.search(word) or word in PERMISSIVE):
            operand_next = False
        else:
            break
        if not operand_next and not depth:
            end = at
    return text[:end].strip()


def _automaton(patterns) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text, value in patterns:
        found.add_word(text, (len(text), value))
    found.make_automaton()
    return found


class Scanner:
    def __init__(self):
        self.phrases = _automaton((f" {p} ", (p, label)) for p, label in PHRASES.items())
        self.tags = _automaton((t, t) for t in TAGS)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str, str]], list[tuple[str, Value | None]]]:
        """Number of words; places (first word, phrase, label) of phrases; tagged expressions with their values."""
        text = text or ""
        words = text.encode().translate(OTHER).split()
        # one byte is one character here, so places in the string are places in the bytes
        line = b" ".join([b"", *words, b""]).decode("latin-1")
        places, counted, at = [], 0, 0
        found = sorted((end - size + 1, phrase, label) for end, (size, (phrase, label)) in self.phrases.iter(line))
        for start, phrase, label in found:
            counted += line.count(" ", at, start)
            at = start
            places.append((counted, phrase, label))
        expressions = []
        lowered = text.lower() if ":" in text else ""
        if len(lowered) != len(text):  # a few letters are longer in lower case; then places differ
            text = lowered
        for end, _ in self.tags.iter(lowered):
            line_end = text.find("\n", end + 1)
            found_text = END_OF_COMMENT.sub("", text[end + 1:line_end if line_end >= 0 else len(text)]).strip()
            if found_text:
                whole = leading_expression(found_text)
                expressions.append((whole or found_text, evaluate(whole) if whole else None))
        return len(words), places, expressions


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


RESULT = ("n_words long, places array<struct<word: bigint, phrase: string, label: string>>, "
          "expressions array<struct<expression: string, ids: array<string>, permissive: boolean>>")


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_words, places (first word, phrase, label of each phrase found), expressions (text, ids and
    permissive; both null if it doesn't parse)."""
    kind = docs.schema[id_col].dataType.simpleString()
    place = pa.list_(pa.struct([("word", pa.int64()), ("phrase", pa.string()), ("label", pa.string())]))
    expression = pa.list_(pa.struct([("expression", pa.string()), ("ids", pa.list_(pa.string())),
                                     ("permissive", pa.bool_())]))

    def find(batches):
        scan = scanner().scan
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                n, places, expressions = [], [], []
                for text in batch.column(1).to_pylist():
                    count, found, tagged = scan(text)
                    n.append(count)
                    places.append([{"word": w, "phrase": p, "label": label} for w, p, label in found])
                    expressions.append([{"expression": e, "ids": sorted(v.ids) if v else None,
                                         "permissive": v.permissive if v else None} for e, v in tagged])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(places, place), pa.array(expressions, expression)],
                    names=["id", "n_words", "places", "expressions"])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        find, f"id {kind}, {RESULT}")
    return found.withColumnRenamed("id", id_col)


def summary(scans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.filter("places", lambda p: p["phrase"].isin(list(BASE_PHRASES)))
    ids = F.flatten(F.transform("expressions", lambda e: F.coalesce(e["ids"], F.array(F.lit("unparsed")))))
    evidence = F.concat(F.transform("places", lambda p: p["label"].isin(list(PERMISSIVE))),
                        F.transform("expressions", lambda e: F.coalesce(e["permissive"], F.lit(False))))
    good = F.size(F.filter(evidence, lambda e: e)).cast("double")
    return scans.withColumn("base", base).select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.word")).alias("first_word"), F.array_max(F.col("base.word")).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.col("base.label"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.col("places.label"), ids))), ",").alias("labels"),
        F.when(F.size(evidence) > 0, good / F.size(evidence)).otherwise(0.0).alias("score"))
