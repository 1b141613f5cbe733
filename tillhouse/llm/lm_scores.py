"""Stupid-backoff scores of all documents under the n-gram counts of the other documents.

With c'(g) the count of n-gram g in all documents but the one being scored, and N' the words of those, the score of a word after
the two before it is

    c'(u v w) / c'(u v)              if c'(u v w) > 0
    BACKOFF * c'(v w) / c'(v)        else if c'(v w) > 0
    BACKOFF ** 2 * max(c'(w), 1/2) / N'

and likewise from the bigram or unigram on for the first two words. A document's score is the sum of the logarithms.

The relations are ``texts`` (document, text), exploded to ``ngrams`` (chunk, hash, n), and ``counts`` (hash, n), exact but for n-grams that
share a 64-bit hash: among 4 * 10**9 different n-grams, one that no other document has is taken for seen with odds of 2 * 10**-10. A chunk is a
few megabytes of documents, stored in buckets where it was read. A chunk's n-grams are counted before they move, so a phrase of every
document is one row per chunk; rows of a chunk and hash range travel packed in one cell, as steps between ascending hashes. Each hash range is summed in one task of bounded size, as
the number of ranges follows the number of words, and joined to the rows that asked; the chunk gets back the counts of its own
n-grams, in its own order, and sums them per document.

Defined results: a text without words (or null) has n_words 0, log_score 0 and a null mean; repeated rows count, and score, each on its own;
with a single document N' is 0 and counts as 1; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.memory import small_batches, trim, trimmed
from tillhouse.llm.shingles import folded_words, mix
from tillhouse.session import ensure_checkpoint_dir

ORDER = 3
BACKOFF = 0.4
CHUNK_BYTES = 4 << 20
CHUNKS_PER_HOME = 8
NGRAMS_PER_RANGE = 4_000_000
BITS = 64
RANDOM_BYTES = 5  # lowest bytes of a step between hashes that no compression makes smaller
_MULTIPLIERS = np.random.default_rng(10).integers(1, 2**62, (ORDER + 1, ORDER), dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def _chunks(docs: DataFrame) -> DataFrame:
    """One row per few megabytes of texts: home (the number of ``CHUNKS_PER_HOME`` neighbouring chunks), chunk, ids and whether each is unknown,
    sizes (bytes of each text), n_words, texts (compressed). Stored in buckets by home, so that the counts come to the texts."""
    def pack(batches):
        task, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def close():
            chunk, raw = task << 24 | number, [(t or "").encode() for t in texts]
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk // CHUNKS_PER_HOME], pa.int64()), pa.array([chunk], pa.int64()),
                 pa.array([[i or 0 for i in ids]], pa.list_(pa.int64())), pa.array([[i is None for i in ids]], pa.list_(pa.bool_())),
                 pa.array([[len(r) for r in raw]], pa.list_(pa.int64())), pa.array([sum(len(r.split()) for r in raw)], pa.int64()),
                 pa.array([zstandard.compress(b"".join(raw), 6)], pa.binary())],
                names=["home", "chunk", "ids", "unknown", "sizes", "n_words", "texts"])

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids += batch.column(0).to_pylist()
                texts += batch.column(1).to_pylist()
                size += pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
                if size >= CHUNK_BYTES:
                    yield close()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield close()

    packed = docs.select("id", "text").mapInArrow(
        trimmed(pack), "home long, chunk long, ids array<long>, unknown array<boolean>, sizes array<long>, n_words long, texts binary")
    spark, name = docs.sparkSession, f"chunks_{uuid.uuid4().hex}"
    packed.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "home").format("parquet").option(
        "path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/settled-{name}").saveAsTable(name)
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # from the catalog; the files stay
    return chunks


def _words(sizes, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a chunk, and how many each text has."""
    raw = zstandard.decompress(blob)
    ends = np.cumsum(np.array(sizes, np.int64))
    each = [np.array([xxhash.xxh3_64_intdigest(w) for w in folded_words(raw[end - n:end].decode())], np.uint64)
            for n, end in zip(sizes, ends.tolist())]
    return np.concatenate([np.zeros(0, np.uint64), *each]), np.array([len(words) for words in each], np.int64)


def _ngrams(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of all n-grams, orders one after the other, and for each order the place of its last word."""
    before = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # words of the text before it
    grams, ends = [], []
    for order in range(1, ORDER + 1):
        last = np.flatnonzero(before >= order - 1)
        total = np.full(len(last), np.uint64(order))
        for k in range(order):
            total += words[last - k] * _MULTIPLIERS[order, k]
        grams.append(mix(total))
        ends.append(last)
    return np.concatenate(grams), ends


def _planes(values: np.ndarray) -> tuple[bytes, bytes]:
    """The bytes of whole numbers, all lowest ones first; the first ``RANDOM_BYTES`` as they are, the others compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return planes[:RANDOM_BYTES].tobytes(), zstandard.compress(planes[RANDOM_BYTES:].tobytes())


def _from_planes(n: int, plain: bytes, packed: bytes) -> np.ndarray:
    planes = np.frombuffer(plain + zstandard.decompress(packed), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8")[:, 0]


def _pack(sorted_hashes: np.ndarray) -> tuple[int, bytes, bytes]:
    """How many there are, and the steps between ascending hashes, the first from zero."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return len(steps), *_planes(steps)


def _unpack(n: int, plain: bytes, packed: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(n, plain, packed), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    """One byte each, compressed; 255 stands for the next of the larger ones."""
    large = counts[counts >= 255]
    return zstandard.compress(np.minimum(counts, 255).astype(np.uint8).tobytes()), large.astype("<u8").tobytes()


def _unpack_counts(small: bytes, large: bytes) -> np.ndarray:
    out = np.frombuffer(zstandard.decompress(small), np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(large, "<u8").astype(np.int64)
    return out


def _asked(chunks: DataFrame, ranges: int) -> DataFrame:
    """The n-grams of each chunk and hash range with their counts in the chunk."""
    starts = np.array([-(-(r << BITS) // ranges) for r in range(ranges)], np.uint64)
    names = ["part", "chunk", "n", "plain", "packed", "small", "large"]

    def count(batches):
        for batch in batches:
            for chunk, sizes, blob in zip(*(batch.column(c) for c in ("chunk", "sizes", "texts"))):
                grams, _ = _ngrams(*_words(sizes.as_py(), blob.as_py()))
                if not len(grams):
                    continue
                different, n = np.unique(grams, return_counts=True)
                cuts = np.append(np.searchsorted(different, starts), len(different))
                rows = []
                for part in np.flatnonzero(np.diff(cuts)).tolist():
                    held = slice(cuts[part], cuts[part + 1])
                    rows.append((part, chunk, *_pack(different[held] - starts[part]), *_pack_counts(n[held])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4))],
                    names=names)

    return chunks.select("chunk", "sizes", "texts").mapInArrow(
        trimmed(count), "part int, chunk long, n int, plain binary, packed binary, small binary, large binary")


def _answered(asked: DataFrame) -> DataFrame:
    """For each chunk and hash range, the corpus counts of its n-grams, in ascending order of hash."""
    def add(frame):
        hashes = [_unpack(*steps) for steps in zip(frame["n"], frame["plain"], frame["packed"])]
        own = np.concatenate([_unpack_counts(a, b) for a, b in zip(frame["small"], frame["large"])])
        ends = np.cumsum([len(h) for h in hashes])
        every = np.concatenate(hashes)
        del hashes
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        total = np.add.reduceat(own[order], first)
        out = np.empty(len(order), np.int64)
        out[order] = np.repeat(total, np.diff(np.append(first, len(every))))
        packed = [_pack_counts(c) for c in np.split(out, ends[:-1])]
        del every, order, own, out, total, first
        trim()
        return pd.DataFrame({"part": frame["part"], "chunk": frame["chunk"], "small": [p[0] for p in packed],
                             "large": [p[1] for p in packed]})

    return asked.groupBy("part").applyInPandas(add, "part int, chunk long, small binary, large binary")


def chunk_scores(words: np.ndarray, lengths: np.ndarray, counts: np.ndarray, n_corpus: int) -> np.ndarray:
    """Sum of log scores per text. ``counts``: corpus counts of the different n-grams of the chunk, ascending by hash."""
    grams, ends = _ngrams(words, lengths)
    _, kind = np.unique(grams, return_inverse=True)
    text = np.repeat(np.arange(len(lengths)), lengths)
    owner = np.concatenate([text[e] for e in ends])
    _, group, own = np.unique(owner << 32 | kind, return_inverse=True, return_counts=True)
    outside = counts[kind] - own[group]
    of_order = np.split(outside, np.cumsum([len(e) for e in ends])[:-1])
    rest = np.maximum(n_corpus - lengths[text], 1)
    value = np.log(np.maximum(of_order[0], 0.5) / rest)  # the unigram's
    ending = [np.zeros(len(words), np.int64) for _ in range(ORDER)]
    for order, (last, n) in enumerate(zip(ends, of_order)):
        ending[order][last] = n  # outside count of the n-gram that ends at a word
    for order in range(2, ORDER + 1):
        last = ends[order - 1]
        value[last] += math.log(BACKOFF)
        seen = last[of_order[order - 1] > 0]
        value[seen] = np.log(ending[order - 1][seen] / ending[order - 2][seen - 1])
    return np.bincount(text, value, len(lengths))


def stupid_backoff(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   ngrams_per_range: int = NGRAMS_PER_RANGE) -> DataFrame:
    """One row per document: id_col, n_words, log_score, mean_log_score."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    small_batches(docs.sparkSession)
    chunks = _chunks(docs)
    n_corpus = chunks.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, -(-ORDER * n_corpus // ngrams_per_range))
    answered = _answered(_asked(chunks, ranges))

    def score(left, right):
        out = []
        answers = {chunk: rows.sort_values("part") for chunk, rows in right.groupby("chunk")}
        for chunk, ids, unknown, sizes, blob in zip(*(left[c] for c in ("chunk", "ids", "unknown", "sizes", "texts"))):
            words, lengths = _words(sizes.tolist(), blob)
            rows = answers.pop(chunk, right.iloc[:0])
            counts = np.concatenate([np.zeros(0, np.int64), *(_unpack_counts(a, b) for a, b in zip(rows["small"], rows["large"]))])
            scores = chunk_scores(words, lengths, counts, n_corpus)
            del words, counts
            trim()
            mean = [s / n if n else None for s, n in zip(scores.tolist(), lengths.tolist())]
            out.append(pd.DataFrame({"id": pd.arrays.IntegerArray(np.array(ids, np.int64), np.array(unknown, bool)), "n_words": lengths,
                                     "log_score": scores, "mean_log_score": pd.array(mean, "Float64")}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "n_words": [], "log_score": [], "mean_log_score": []})

    left = chunks.select("home", "chunk", "ids", "unknown", "sizes", "texts").groupBy("home")
    right = answered.withColumn("home", F.expr(f"chunk div {CHUNKS_PER_HOME}")).groupBy("home")
    scored = left.cogroup(right).applyInPandas(score, "id long, n_words long, log_score double, mean_log_score double")
    return scored.withColumnRenamed("id", id_col)
