"""Repair of the turn order of conversations by the cheapest edits.

A conversation's rows stand by turn (nulls first); rows of one turn by role, the first 32 characters of their text and a
hash of it. A row's first fault counts: ``blank`` (no character but white space), ``duplicate`` (its role and text were seen earlier), ``truncated``
(the last character that is not white space is none of ``.!?``). Edits and their costs: Keep 0, Rerole to user or assistant 2, Delete 3, Insert an
empty user or assistant turn 2; a truncated row that is not deleted adds 1; blank and duplicate rows must go. The initials
of the roles must then read ``(s?(ua)+)?``, which four states follow: nothing yet, after s, after u, after a. Of the cheapest repairs, the one whose edits'
initials are least as ASCII text is taken.

The shortest path over four states is found by Viterbi in parallel over chunks, however long a conversation is:

1. ``ordered``: one range shuffle of narrow rows gives each row its place; a conversation may lie in many partitions.
2. ``chunks``: up to ``CHUNK`` neighbouring rows become one row with two letters a row, its initial and its fault.
3. ``solve``: each chunk computes, from its end to its start, what the rest costs from each state. The last chunk of a
   conversation knows the true costs at its end, the others start from a speculative vector. Then fix-up passes: a chunk whose right neighbour now hands it a
   vector that differs by more than a constant runs again. A constant never changes a choice. A pass settles at least the last unsettled chunk of
   each conversation, and mostly all, as the ranks of the products fall to one within a few rows.
4. ``trace``: each chunk follows its least edits from each of the four states; the exits are strung together per
   conversation (four letters a chunk), and the chunk follows them once more from its true state.
5. ``replay``: the texts are shuffled once, by conversation, and take their edits in order as a stream. A worker holds one row and the edits not yet used.

Lists of chunks of one conversation (a row for 16,384 of its rows) and the finished audit (one letter an edit) are the only things of a
conversation that stand in one place; the hash of a whole repaired text has to read it in order.

Defined results: a null text or role is one space, so the text is blank and the role is of no known initial; a null conversation id is a conversation; null
turns come first; repeated rows are duplicates; an empty table gives no rows; other columns are ignored. A conversation without rows has zeros, an
empty audit and the hash of an empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import settle

CHUNK = 1 << 14  # rows; a power of two
SPACE = " \t\n\x0b\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs; keeping costs nothing
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = (USER, USER, ASSISTANT, USER)  # the state after an insertion or a rerole, from each state
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "o": (None,) * 4}
AT_END = (0, 4, 2, 0)  # the insertions that are still needed
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


# Rows and their places

def plain(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): every row once, nulls as one space."""
    space = F.lit(" ")
    return conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                                F.lit(1).alias("copies"))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``plain`` with made faults, by the checksum of "conv_id:turn" modulo 20: 0 drops the row (no copies), 1 empties its text, 2 takes
    its sentence ends away, 3 repeats it, 4 makes its role user."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20
    return plain(conversations).withColumns({
        "text": F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(fault == 4, "user").otherwise(F.col("role")),
        "copies": F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)})


ORDER = ["conv_id", "turn", "role", "head", "mark"]


def _order() -> dict[str, Column]:
    """How rows of one turn stand; rows that are equal in it are the same row."""
    return {"head": F.substring("text", 1, 32), "mark": F.xxhash64("text")}


def _letters() -> dict[str, Column]:
    first = F.substring("role", 1, 1)
    body = F.rtrim("text", F.lit(SPACE))
    return {"initial": F.when(first.isin("s", "u", "a"), first).otherwise("o"),
            "blank": body == "",
            "truncated": ~F.coalesce(F.right(body, F.lit(1)).isin(".", "!", "?"), F.lit(False)),
            "digest": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))}


def _each_copy(rows: DataFrame) -> DataFrame:
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))


def ordered(rows: DataFrame) -> DataFrame:
    """Narrow rows with their ``place``, a number that rises along each conversation. Written once. Equal rows may part
    anywhere (``part``), so not even one row repeated very often fills one task."""
    narrow = _each_copy(rows.withColumns(_order() | _letters())).withColumn("part", F.monotonically_increasing_id() % 65_536)
    keys = [*ORDER, "part"]
    narrow = narrow.select(*keys, "initial", "blank", "truncated", "digest")
    return settle(narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()).drop("part"))


def statistics(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank) of every conversation, also of one without rows."""
    here = F.col("copies") > 0
    blank = F.when(_letters()["blank"], F.col("copies")).otherwise(0)
    turns = rows.groupBy("conv_id", "turn").agg(F.sum(blank).alias("blank"), F.bool_or(here).alias("here"))
    turn = F.when(F.col("here"), F.col("turn").cast("long"))
    gaps = F.max(turn) - F.min(turn) + 1 - F.count(turn)
    return turns.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), F.sum("blank").alias("blank"))


def chunks(placed: DataFrame, size: int = CHUNK) -> DataFrame:
    """(conv_id, at, next_at, alone, first, initials, faults): neighbouring rows of a conversation as two texts with a letter a row. ``at`` is the
    place of the first row and names the chunk, ``next_at`` is -1 for the last chunk of a conversation, ``first`` has the order columns of
    the first row. Faults are x (must go), t (truncated) and . (none)."""
    first = placed.where(~F.col("blank")).groupBy("conv_id", "digest").agg(F.min("place").alias("place"))
    marked = placed.join(first.select("place", F.lit(True).alias("live")), "place", "left")
    fault = F.when(F.col("live").isNull(), "x").when(F.col("truncated"), "t").otherwise(".")
    listed = marked.groupBy("conv_id", F.shiftright("place", size.bit_length() - 1).alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct("place", "initial", fault.alias("fault")))).alias("rows"),
        F.min(F.struct("place", *ORDER)).alias("first"))
    found = settle(listed.select("conv_id", F.col("first.place").alias("at"), "first", F.array_join("rows.initial", "").alias("initials"),
                                 F.array_join("rows.fault", "").alias("faults")))
    along = Window.partitionBy("conv_id").orderBy("at")
    linked = found.select("conv_id", "at").select("at", F.lead("at", 1, -1).over(along).alias("next_at"), F.lag("at").over(along).isNull().alias("alone"))
    return settle(found.join(linked.withColumn("alone", F.col("alone") & (F.col("next_at") < 0)), "at"))


# Costs and edits of a chunk

@lru_cache(1 << 16)
def step(after: tuple, initial: str, fault: str) -> tuple[tuple, str]:
    """Costs before a row from the costs after it, less the smallest, and the first letter of the least cheapest edits from each state."""
    if fault == "x":
        return after, "DDDD"
    extra = TRUNCATED if fault == "t" else 0
    options = []
    for state in range(4):
        own = {"D": DELETE + after[state], "R": REROLE + extra + after[INSERTED[state]]}
        if KEPT[initial][state] is not None:
            own["K"] = extra + after[KEPT[initial][state]]
        options.append(own)
    best = [min(own.values()) for own in options]
    for _ in range(2):  # two insertions lead from any state back to user or assistant
        best = [min(best[state], INSERT + best[INSERTED[state]]) for state in range(4)]
    for state, own in enumerate(options):
        own["I"] = INSERT + best[INSERTED[state]]
    letters = "".join(min(letter for letter, cost in own.items() if cost == best[state]) for state, own in enumerate(options))
    return tuple(cost - min(best) for cost in best), letters


def costs_before(initials: str, faults: str, end) -> tuple:
    """What the rest costs from each state at the start of a chunk, up to a constant."""
    now = tuple(end)
    for initial, fault in zip(reversed(initials), reversed(faults)):
        now = step(now, initial, fault)[0]
    return now


def choices(initials: str, faults: str, end) -> list[str]:
    now, letters = tuple(end), []
    for initial, fault in zip(reversed(initials), reversed(faults)):
        now, four = step(now, initial, fault)
        letters.append(four)
    return letters[::-1]


def follow(initials: str, faults: str, letters: list[str], state: int, last: bool) -> tuple[int, str, int]:
    """(state after the chunk, audit, cost) of the least edits from a state on."""
    audit, cost = [], 0
    for initial, fault, four in zip(initials, faults, letters):
        while four[state] == "I":
            audit.append("I")
            cost, state = cost + INSERT, INSERTED[state]
        letter = four[state]
        audit.append(letter)
        if letter == "D":
            cost += DELETE
        else:
            cost += (TRUNCATED if fault == "t" else 0) + (REROLE if letter == "R" else 0)
            state = INSERTED[state] if letter == "R" else KEPT[initial][state]
    while last and AT_END[state]:
        audit.append("I")
        cost, state = cost + INSERT, INSERTED[state]
    return state, "".join(audit), cost


def _pandas(df: DataFrame, build, schema: str) -> DataFrame:
    """``build`` turns one row into one tuple."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(frames):
        for frame in frames:
            yield pd.DataFrame([build(row) for row in frame.itertuples(index=False)], columns=names)

    return df.mapInPandas(run, schema)


# Chunks against each other

def solve(found: DataFrame) -> tuple[DataFrame, int]:
    """(at, end): the costs at the end of each chunk, right up to a constant; and the number of fix-up passes. Only chunks of
    conversations with several of them are given."""
    links = "at long, next_at long, initials string, faults string, "
    schema = links + "end array<int>, start array<int>"

    def first(row):
        end = AT_END if row.next_at < 0 else (0, 0, 0, 0)
        return row.at, row.next_at, row.initials, row.faults, end, costs_before(row.initials, row.faults, end)

    def again(row):
        stale = row.handed is not None and list(row.handed) != list(row.end)
        end = row.handed if stale else row.end
        start = costs_before(row.initials, row.faults, map(int, end)) if stale else row.start
        return row.at, row.next_at, row.initials, row.faults, end, start

    now, passes = settle(_pandas(found.select("at", "next_at", "initials", "faults"), first, schema)), 0
    while True:
        handed = now.select(F.col("at").alias("next_at"), F.col("start").alias("handed"))
        joined = now.join(handed, "next_at", "left")
        if joined.where(F.col("handed") != F.col("end")).isEmpty():
            return now.select("at", "end"), passes
        now, passes = settle(_pandas(joined, again, schema)), passes + 1


def enter(found: DataFrame) -> DataFrame:
    """(at, entry): the state in which the least edits come to each chunk. ``found`` has the chunks with their ``end``."""
    def exits(row):
        letters = choices(row.initials, row.faults, map(int, row.end))
        return row.at, "".join(str(follow(row.initials, row.faults, letters, s, False)[0]) for s in range(4))

    maps = _pandas(found.select("at", "initials", "faults", "end"), exits, "at long, exits string")
    strung = maps.join(found.select("at", "conv_id"), "at").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "exits"))).alias("maps")).select("maps")

    def walk(frames):
        for frame in frames:
            for maps in frame.maps:
                state, rows = NOTHING, []
                for one in maps:
                    rows.append((one["at"], state))
                    state = int(one["exits"][state])
                yield pd.DataFrame(rows, columns=["at", "entry"])

    return strung.mapInPandas(walk, "at long, entry int")


def trace(found: DataFrame) -> DataFrame:
    """(conv_id, at, first, audit, cost, must_go, truncated) for each chunk."""
    several = found.where(~F.col("alone"))
    if several.isEmpty():
        full = found.withColumns({"end": F.lit(None).cast("array<int>"), "entry": F.lit(NOTHING)})
    else:
        ends = settle(several.join(solve(several)[0], "at"))
        full = found.join(ends.select("at", "end"), "at", "left").join(enter(ends), "at", "left")

    def run(row):
        end = AT_END if row.end is None else tuple(map(int, row.end))
        entry = NOTHING if pd.isna(row.entry) else int(row.entry)
        letters = choices(row.initials, row.faults, end)
        _, audit, cost = follow(row.initials, row.faults, letters, entry, row.next_at < 0)
        return row.at, audit, cost, row.faults.count("x"), row.faults.count("t")

    traced = _pandas(full.select("at", "next_at", "initials", "faults", "end", "entry"), run,
                     "at long, audit string, cost long, must_go long, truncated long")
    return traced.join(found.select("at", "conv_id", "first"), "at")


# Edits against rows

class Replay:
    """The rows of one conversation after another, in order, with the edits of their chunks ahead of them."""

    def __init__(self):
        self.conv, self.state, self.audit, self.used = None, NOTHING, [], 0
        self.must_go = self.truncated = self.cost = self.illegal = 0
        self.before = None
        self.waiting: list[str] = []  # chunks whose edits are not used up; ``used`` letters of the first are
        self.written = 0

    def edits(self, audit, cost, must_go, truncated) -> None:
        self.audit.append(audit)
        self.waiting.append(audit)
        self.cost, self.must_go, self.truncated = self.cost + cost, self.must_go + must_go, self.truncated + truncated

    def _letter(self) -> str | None:
        while self.waiting and self.used == len(self.waiting[0]):
            self.waiting.pop(0)
            self.used = 0
        if not self.waiting:
            return None
        self.used += 1
        return self.waiting[0][self.used - 1]

    def _insert(self) -> tuple[str, str, str]:
        self.state = INSERTED[self.state]
        return "I", NAMES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Repaired rows up to this one, as (edit, role, text)."""
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        while (letter := self._letter()) == "I":
            yield self._insert()
        if letter == "K":
            self.state = KEPT[role[0]][self.state]
            yield "K", role, text
        elif letter == "R":
            self.state = INSERTED[self.state]
            yield "R", NAMES[self.state], text

    def rest(self) -> Iterator[tuple[str, str, str]]:
        while self._letter() is not None:
            yield self._insert()


def _together(rows: DataFrame, traced: DataFrame) -> DataFrame:
    """Rows and chunks, dealt by conversation and in order; a chunk stands before its first row. Of equal rows, some may belong
    to a chunk that stands behind them; its letters are then used by its equal rows, in the same order."""
    numbers = ["cost", "must_go", "truncated"]
    texts = _each_copy(rows.withColumns(_order())).select(
        *ORDER, F.lit(None).cast("long").alias("at"), "text", F.lit(None).cast("string").alias("audit"),
        *(F.lit(0).cast("long").alias(n) for n in numbers))
    edits = traced.select("conv_id", *(F.col(f"first.{c}").alias(c) for c in ORDER[1:]), "at", F.lit(None).cast("string").alias("text"), "audit", *numbers)
    return texts.unionByName(edits).repartition("conv_id").sortWithinPartitions(*ORDER, F.asc_nulls_last("at"))


def _replayed(batches) -> Iterator[tuple[Replay, tuple | None]]:
    """Each repaired row with its conversation, and the conversation once more at its end, with None."""
    now = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit", "cost", "must_go", "truncated")]
        for conv, role, text, audit, *numbers in zip(*columns):
            if now is None or now.conv != conv:
                if now is not None:
                    yield from ((now, row) for row in now.rest())
                    yield now, None
                now = Replay()
                now.conv = conv
            if audit is not None:
                now.edits(audit, *numbers)
            else:
                yield from ((now, row) for row in now.row(role, text))
    if now is not None:
        yield from ((now, row) for row in now.rest())
        yield now, None


class Repair:
    """The cheapest repair of every conversation in ``rows`` (as ``plain`` or ``damage`` give them)."""

    def __init__(self, rows: DataFrame, chunk: int = CHUNK):
        self.given = rows
        self.traced = settle(trace(chunks(ordered(rows), chunk)))
        self.kind = rows.schema["conv_id"].dataType.simpleString()

    def rows(self) -> DataFrame:
        """(conv_id, number, edit, role, text): the repaired conversations, numbered from 1."""
        out = f"conv_id {self.kind}, number long, edit string, role string, text string"

        def run(batches):
            some = []
            for conv, row in _replayed(batches):
                if row is not None:
                    conv.written += 1
                    some.append((conv.conv, conv.written, *row))
                if len(some) >= 1000:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some])
                    some = []
            if some:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some])

        names = ["conv_id", "number", "edit", "role", "text"]
        return _together(self.given, self.traced).mapInArrow(run, out)

    def report(self) -> DataFrame:
        """One row per conversation, see ``REPORT``. The hash is of the repaired rows "role:text", joined by line feeds."""
        schema = f"conv_id {self.kind}, must_go long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
        names = [part.split()[0] for part in schema.split(", ")]

        def run(batches):
            some, digest = [], hashlib.sha256()
            for conv, row in _replayed(batches):
                if row is not None:
                    digest.update(f"{chr(10) if conv.written else ''}{row[1]}:{row[2]}".encode())
                    conv.written += 1
                    continue
                some.append((conv.conv, conv.must_go, conv.truncated, conv.illegal, conv.cost, "".join(conv.audit), digest.hexdigest()))
                digest = hashlib.sha256()
                if len(some) >= 1000:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some])
                    some = []
            if some:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some])

        streamed = _together(self.given, self.traced).mapInArrow(run, schema)
        both = statistics(self.given).unionByName(streamed, allowMissingColumns=True)
        zero = F.lit(0).cast("long")
        sums = {c: F.coalesce(F.sum(c), zero) for c in ("gaps", "blank", "truncated", "illegal", "cost")}
        return both.groupBy("conv_id").agg(
            *(c.alias(n) for n, c in sums.items()), (F.coalesce(F.sum("must_go"), zero) - sums["blank"]).alias("duplicate"),
            F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
            F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256")).select(*REPORT)
