"""Byte-level BPE from a rank file, encoded in linear time and decoded.

A text is cut by the vocabulary's pattern, and each match is encoded on its own. Bytes are read as Latin-1 characters, so an
Aho-Corasick automaton over all tokens finds the longest token that starts at each byte. The encoder goes from left to right, takes the longest
token and keeps it if it is *compatible* with the token before it: merging the two neighbours' bytes gives these two tokens again. Otherwise it
tries the next shorter token, and where none is left it takes the last token back and marks the place as one that no encoding passes. Each place is given up
at most once, so the work is linear in the bytes; and a sequence whose neighbours are all compatible is the one that the merges make.

Whether two tokens are compatible depends on these two only. It is found by undoing their merges from the highest rank
down, and remembered.

Ranks must be in merge order: a token that merges can make is made of two tokens of lower rank (checked when the file is read). A token that no
merges make is used only where it is a whole match, as the public library does.

The character classes of the pattern are taken from the public library itself (``stand_ins``), as regex libraries know different
versions of Unicode.

Defined results: a null or empty text has no ids, and no ids decode to no bytes; null ids decode to null; rows that repeat and null keys
are kept as they are; other columns are ignored; an empty table gives no rows. An id that the vocabulary lacks is an error.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BYTES_AT_ONCE = 4_000_000
MOST_PIECES = 200_000  # kept per worker: the pieces of this and of the last table
LONGEST_KEPT = 48  # bytes
MOST_PAIRS = 1_000_000

ENCODERS: dict[tuple[str, str], ByteBpe] = {}


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: merge the neighbours of least rank, the first of equals, until none can be merged."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks):
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


@lru_cache
def stand_ins() -> dict[int, str]:
    """Characters that the regex module and the public library put in different classes, each with a plain character of the public
    library's class. The library skips what its pattern does not match, so it lists a class by itself."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    single = {bytes([b]): b for b in range(256)}
    differ: dict[int, str] = {}
    classes = {r"\p{L}": "z", r"\p{N}": "0", r"\s": "\t"}
    known: dict[str, set[str]] = {}
    for name in classes:
        lists = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        known[name] = set(lists.decode_bytes(lists.encode_ordinary(every)).decode())
        for c in known[name] ^ set(regex.findall(name, every)):
            differ[ord(c)] = "!"
    return {c: next((plain for name, plain in classes.items() if chr(c) in known[name]), "!") for c in differ}


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.unlike = frozenset(map(chr, stand_ins()))
        self.lengths = list(map(len, self.tokens))
        self.made_of: list[tuple[int, int] | None] = [None] * len(self.tokens)  # the two tokens merged last
        self.made_by: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter = [-1] * len(self.tokens)  # longest token that is a proper prefix
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path} has no token for the bytes {missing}")
        self.automaton = ahocorasick.Automaton()
        usable = [rank for rank, token in enumerate(self.tokens) if len(token) == 1 or (token and self._undo(rank, token))]
        reachable = set(usable)
        for rank in usable:
            token = self.tokens[rank]
            self.automaton.add_word(token.decode("latin-1"), rank)
            for n in range(len(token) - 1, 0, -1):
                found = self.ranks.get(token[:n], -1)
                if found in reachable:
                    self.shorter[rank] = found
                    break
        self.automaton.make_automaton()

    def _undo(self, rank: int, token: bytes) -> bool:
        """Find the two tokens whose merge makes this one. Ranks come in rising order."""
        for n in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:n], rank), self.ranks.get(token[n:], rank)
            if left < rank and right < rank and self._whole(left) and self._whole(right) and self._check(left, right):
                self.made_of[rank] = (left, right)
                self.made_by[left, right] = rank
                return True
        if merged(token, self.ranks) == [token]:
            raise ValueError(f"token {rank} is merged from tokens of higher rank")
        return False

    def _whole(self, rank: int) -> bool:
        return self.lengths[rank] == 1 or self.made_of[rank] is not None

    def compatible(self, left: int, right: int) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self._check(left, right)
        return found

    def _check(self, left: int, right: int) -> bool:
        """Undo the later one of the two tokens' last merges, again and again. The neighbours across the border must never have been
        ready to merge before that merge happened."""
        limit = len(self.tokens)
        while True:
            # of equal ranks, the left one was merged first
            if self.made_by.get((left, right), limit) < limit:
                return False
            l_parts, r_parts = self.made_of[left], self.made_of[right]
            if l_parts is None and r_parts is None:
                return True
            if r_parts is None or (l_parts is not None and left > right):
                limit, left = left, l_parts[1]
            else:
                # a merge of the same rank further left would have come before this one
                limit, right = right + 1, r_parts[0]

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest = [-1] * size
        lengths, shorter, pairs = self.lengths, self.shorter, self.pairs
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # of one start, longer ones end later
        open_places = bytearray(b"\1") * (size + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            last = taken[-1] if taken else -1
            while token >= 0:
                if open_places[at + lengths[token]] and (last < 0 or (
                        pairs[last, token] if (last, token) in pairs else self.compatible(last, token))):
                    break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                at += lengths[token]
                token = longest[at] if at < size else -1
            else:  # no encoding passes here
                open_places[at] = 0
                token = taken.pop()
                at -= lengths[token]
                token = shorter[token]
        return taken

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and not self.unlike.isdisjoint(text):
            spans = (m.span() for m in self.pattern.finditer(text.translate(stand_ins())))
            return [text[a:b] for a, b in spans]
        return self.pattern.findall(text)

    def ids(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.pieces(text)
        found = list(map(self.known.get, parts))
        if None in found:
            found = [self._learn(part) if ids is None else ids for part, ids in zip(parts, found)]
        return b"".join(found)

    def _learn(self, part: str) -> bytes:
        ids = self.known.get(part) or self.older.get(part)
        if ids is None:
            ids = pack(self.piece(part.encode()))
            if len(part) > LONGEST_KEPT:
                return ids
        if len(self.known) >= MOST_PIECES:
            self.older, self.known = self.known, {}
        self.known[part] = ids
        return ids

    def text(self, ids: Iterable[int]) -> bytes:
        try:
            return b"".join([self.tokens[i] or self._unknown(i) for i in ids])
        except IndexError:
            raise ValueError("an id is not in the vocabulary") from None

    def _unknown(self, i: int):
        raise ValueError(f"id {i} is not in the vocabulary")


def encoder(path: str, pattern: str) -> ByteBpe:
    """One per worker process and vocabulary."""
    if (path, pattern) not in ENCODERS:
        ENCODERS[path, pattern] = ByteBpe(path, pattern)
    return ENCODERS[path, pattern]


def _few(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BYTES_AT_ONCE`` bytes of the second column, one row at least."""
    column = batch.column(1)
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)).cumsum() if batch.num_rows else []
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BYTES_AT_ONCE, side="right"))
        end = max(end, at + 1)
        yield batch.slice(at, end - at)
        at = end


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) for each row. No shuffle; a worker keeps a bounded table of the pieces it has met."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = encoder(path, pattern)
        for batch in batches:
            for few in _few(batch):
                raw = [bpe.ids(t.as_py() or "") for t in few.column(1)]
                offsets = np.zeros(len(raw) + 1, np.int32)
                np.cumsum([len(r) // 4 for r in raw], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(raw), "<i4"))
                yield pa.RecordBatch.from_arrays([few.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["key", "ids"])

    named = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids",
           keep_ids: bool = False) -> DataFrame:
    """(id_col, bytes binary): the bytes that the ids stand for; they need not be UTF-8, as any ids may be given. With ``keep_ids``
    also the ids."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                few = batch.slice(at, 64)
                raw = [None if ids is None else bpe.text(ids) for ids in
                       (None if not x.is_valid else x.values.to_numpy(zero_copy_only=False).tolist() for x in few.column(1))]
                columns = {"key": few.column(0), "bytes": pa.array(raw, pa.binary())} | ({"ids": few.column(1)} if keep_ids else {})
                yield pa.RecordBatch.from_pydict(columns)

    named = encoded.select(F.col(id_col).alias("key"), F.col(ids_col).cast("array<int>").alias("ids"))
    decoded = named.mapInArrow(run, f"key {kind}, bytes binary" + (", ids array<int>" if keep_ids else ""))
    return decoded.withColumnsRenamed({"key": id_col, "ids": ids_col})
