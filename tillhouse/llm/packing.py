"""Best-fit packing planned over a histogram of lengths.

1. ``token_pieces`` encodes whole texts, appends an end id and cuts what is longer than a sequence.
2. ``plan`` runs best-fit decreasing over the *counts* of each length, on the driver. Its input has at most
   ``capacity`` rows however many documents there are. It moves whole runs of equal sequences at once, and
   returns runs: "the documents of length L with ranks r .. r+n-1 go to sequences s .. s+n-1 at offset o".
3. ``place`` gives each piece its rank within its length and looks its run up. The rank is the rank within the
   task that made the piece, kept beside it, plus the pieces of that length in earlier tasks. So no length, however
   common, is gathered or sorted in one place.

Defined results: a null or empty text is one piece that holds the end id only; repeated rows are packed each on its own;
a null id is kept; an empty table gives no rows; other columns of the input are ignored unless named in ``keep``, and
a kept column may not have the name of an output column.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.encoding import id_width, word_encoder
from tillhouse.llm.memory import trimmed
from tillhouse.session import settle

CAPACITY = 2048


def token_pieces(docs: DataFrame, tokenizer_path: str, *, end_id: int, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id_col, piece, start (ids of the document before it), length, ids (little-endian, two bytes
    each where the vocabulary allows, else four), ids_crc32 (of the ids as four-byte integers), and the task and rank within task and length it was made with.

    Written once to the checkpoint folder, so that what is counted and what is placed are the same rows.
    """
    width = id_width(tokenizer_path)
    item = np.dtype(width).itemsize
    out = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("made_in", pa.int64()), ("made_rank", pa.int64())])

    @trimmed
    def cut(batches):
        encoder, seen = word_encoder(tokenizer_path), defaultdict(int)
        task = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in out.names}
            for key, raw in encoder.encode_batch(batch):
                raw += end
                ids = np.frombuffer(raw, "<u4").astype(width).tobytes()
                total = len(raw) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    stop = min(total, start + capacity)
                    n = stop - start
                    for column, value in zip(rows.values(), (
                            key, piece, start, n, ids[start * item:stop * item],
                            zlib.crc32(raw[4 * start:4 * stop]), task, seen[n])):
                        column.append(value)
                    seen[n] += 1
            yield pa.RecordBatch.from_pydict(rows, schema=out)

    pieces = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        cut, "id long, piece int, start long, length long, ids binary, ids_crc32 long, made_in long, "
        "made_rank long")
    return settle(pieces.withColumnRenamed("id", id_col))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over counts. Columns of the result: length, first rank, first sequence, offset."""
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: runs of (first sequence, how many)
    rooms = 0  # bit r is set if there is a run with room r
    runs, opened = [], 0

    def add(room: int, first: int, n: int) -> None:
        nonlocal rooms
        if room and n:
            free[room].append((first, n))
            rooms |= 1 << room

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        while left:
            if fitting := rooms >> length:
                room = length + (fitting & -fitting).bit_length() - 1
                first, n = free[room].pop()
                taken = min(n, left)
                if taken < n:
                    free[room].append((first + taken, n - taken))
                if not free[room]:
                    rooms &= ~(1 << room)
                runs.append((length, rank, first, capacity - room))
                add(room - length, first, taken)
                rank, left = rank + taken, left - taken
            else:
                each = capacity // length
                full, rest = divmod(left, each)
                for n, slots in ((full, each), (1, rest)):
                    if n and slots:
                        for slot in range(slots):
                            runs.append((length, rank, opened, slot * length))
                            rank += n
                        add(capacity - slots * length, opened, n)
                        opened += n
                left = 0
    return np.array(runs, np.int64).reshape(-1, 4)


def place(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with length, made_in, made_rank; other columns pass) plus sequence_id and offset."""
    groups = pieces.groupBy("length", "made_in").agg(F.count("*").alias("n_made"))
    groups = settle(groups)  # one row per task and length
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n_made").alias("n")).collect()}
    runs = plan(counts, capacity)  # at most ``capacity`` lengths
    earlier = Window.partitionBy("length").orderBy("made_in").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select("length", "made_in", F.coalesce(F.sum("n_made").over(earlier), F.lit(0)).alias("made_before"))
    ranked = pieces.join(before, ["length", "made_in"]).withColumn(
        "rank_in_length", F.col("made_before") + F.col("made_rank"))
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    kept = [c for c in pieces.columns if c not in ("made_in", "made_rank")]
    fields = [ranked.schema[c] for c in kept] + [T.StructField("sequence_id", T.LongType()),
                                                 T.StructField("offset", T.LongType())]

    def look_up(batches):
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank_in_length").to_numpy()
            run = runs[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 3])],
                names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "rank_in_length").mapInArrow(look_up, T.StructType(fields))
