"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from tillhouse.llm import conversations as C
from tillhouse.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def repaired(rows):
    """rows in order: (role, text) -> (blank, duplicate, truncated, illegal, cost, audit, repaired rows)."""
    faults, seen = [], set()
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, state, inserted):
        """(cost, audit, rows) from row i on; at most three insertions in a row are of use."""
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            (role, text), extra = rows[i], faults[i] == "t"
            cost, audit, rest = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, rest))
            if faults[i] not in ("b", "d"):
                if (state, role[:1]) in grammar:
                    cost, audit, rest = best(i + 1, grammar[state, role[:1]], 0)
                    found.append((cost + extra, "K" + audit, ((role, text), *rest)))
                for name in ("user", "assistant"):
                    if (state, name[0]) in grammar:
                        cost, audit, rest = best(i + 1, name[0], 0)
                        found.append((cost + 2 + extra, "R" + audit, ((name, text), *rest)))
        if inserted < 3:
            for name in ("user", "assistant"):
                if (state, name[0]) in grammar:
                    cost, audit, rest = best(i, name[0], inserted + 1)
                    found.append((cost + 2, "I" + audit, ((name, ""), *rest)))
        return min(found, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    count = Counter(faults)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return count["b"], count["d"], count["t"], illegal, cost, audit, list(out)


def report(rows, originals):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append(((turn is not None, turn or 0), role, text[:32], hash(text), turn, text))
    out = {}
    for conv in originals:
        own = sorted(by_conv[conv])
        turns = {r[4] for r in own if r[4] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        *numbers, audit, kept = repaired([(r[1], r[5]) for r in own])
        out[conv] = (gaps, *numbers, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest())
    return out


def made(seed, conversations=60, most=14):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(1, most)):
            role = rng.choices([["user", "assistant"][turn % 2], "system", "user", "assistant", "tool", "", None], [8, 1, 1, 1, 1, .3, .3])[0]
            text = rng.choice(["Yes.", "No!", "ends open", "What?\n ", "", " \t", None, "x" * 40 + "1.", "é 日."]) if rng.random() < .6 else f"{rng.random()}."
            rows.append((conv, None if rng.random() < .05 else turn + (rng.random() < .1), role, text))
    # rows of one turn stand by role and the start of their text; keep those apart that only a hash would order
    seen, out = set(), []
    for r in rows:
        key = (r[0], r[1], r[2], (r[3] or " ")[:32])
        if key not in seen:
            out.append(r)
        seen.add(key)
    return out


@pytest.mark.parametrize("chunk", [C.CHUNK, 4, 1])
def test_against_a_plain_search(spark, chunk):
    rows = made(chunk)
    given = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", audit string, place long")
    for build, plain in ((C.damage, damaged(rows)), (C.plain, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])):
        got = {r.conv_id: tuple(r)[1:] for r in C.Repair(build(given), chunk).report().collect()}
        assert got == report(plain, {r[0] for r in rows})


def test_vectors_converge_in_few_passes(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"{t}.") for t in range(400)]
    placed = C.ordered(C.plain(spark.createDataFrame(rows, SCHEMA)))
    found = C.chunks(placed, 8)
    assert found.count() >= 50
    ends, passes = C.solve(found)
    assert 1 <= passes <= 5
    right = found.select("at", "initials", "faults").orderBy("at").collect()
    now = C.AT_END
    want = {}
    for r in reversed(right):
        want[r.at] = [x - min(now) for x in now]
        now = C.costs_before(r.initials, r.faults, now)
    assert {r.at: r.end for r in ends.collect()} == want


def test_large_ids_beside_a_null_one(spark):
    """Numbers above 2**53 are kept exact although a null stands beside them."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for c in (None, 2**60, 2**60 + 1) for t in range(6 + (c or 0) % 2)]
    got = {r.conv_id: tuple(r)[1:] for r in C.Repair(C.plain(spark.createDataFrame(rows, SCHEMA)), 2).report().collect()}
    assert got == report(rows, {None, 2**60, 2**60 + 1})


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "More?"), (2, 0, "system", "Rules."), (3, 0, "user", " ")]
    got = C.Repair(C.plain(spark.createDataFrame(rows, SCHEMA))).rows().orderBy("conv_id", "number").collect()
    by_conv = defaultdict(list)
    for r in got:
        by_conv[r.conv_id].append((r.edit, r.role, r.text))
    for conv in (1, 2, 3):
        _, _, _, _, _, audit, want = repaired([(r[2], r[3]) for r in rows if r[0] == conv])
        assert [x[1:] for x in by_conv[conv]] == want
        assert "".join(x[0] for x in by_conv[conv]) == audit.replace("D", "")


def test_one_row_repeated_very_often(spark):
    rows = [(7, None, "user", "same text.")] * 3000 + [(7, 5, "assistant", "answer.")]
    (got,) = C.Repair(C.plain(spark.createDataFrame(rows, SCHEMA)), 64).report().collect()
    assert (got.duplicate, got.cost, got.audit) == (2999, 3 * 2999, "K" + "D" * 2999 + "K")


def test_conversations_without_rows_and_empty_table(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    given = spark.createDataFrame([(dropped, 0, "user", "Gone.")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in C.Repair(C.damage(given)).report().collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]
    assert C.Repair(C.damage(given.limit(0))).report().collect() == []


def test_query_against_a_plain_search(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, folder).collect()}
    assert got == report(damaged(rows), {r[0] for r in rows})
