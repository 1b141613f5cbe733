"""Raw token-id shards with a minimal-perfect-hash index from document key to place.

``write`` lays a table out below one folder of a store that all machines share::

    shard-<task>-<number>.ids    header, then key and length of each document, then the ids, little-endian
    index-<bucket>.mph           for the keys of one hash bucket: where each key's document lies
    entries/, shards/            the same places as tables, for scans
    repeats/                     places of the second and later documents of a key

Documents stand in ascending key order over the shards, null keys first. A shard is closed once it holds
``shard_bytes`` of ids, so a file is bounded by that and one document.

The index of a bucket is a cascade of bit arrays. In each level a key hashes to a bit; keys that are alone on their bit
are settled there, the others go on to the next level. The number of set bits before a key's bit is its slot: n keys use
the slots 0 .. n-1. A slot stores a 32-bit fingerprint of its key (an absent key is recognised but for one chance in
2**32; the shard then holds another key, which ``fetch`` rules out by comparing the stored key) and the place. A
lookup touches one bit per level and one slot: constant time, whatever the size of the corpus.

Keys are 64-bit integers and are mixed by a bijection, so two keys never share a hash. A key that occurs more than
once has one slot for its first document; the others are found in ``repeats``. Rows with a null key are written and
scanned, but a key lookup cannot name them. A null text is an empty one. An empty table writes no files. Files are
renamed into place when complete, and a task that runs again writes the same bytes under the same name.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.encoding import id_width, word_encoder
from tillhouse.session import ensure_checkpoint_dir

SHARD_BYTES = 16 << 20
KEYS_PER_BUCKET = 1 << 16
BITS_PER_KEY = 2
MAGIC = b"TOKIDS01"
HEADER = "<8sIIQQ"  # magic, bytes per id, 0, documents, ids
HEADER_BYTES = struct.calcsize(HEADER)
PLACE = ["made_in", "shard", "ordinal", "start", "n_tokens"]  # start: ids of the shard before the document
ENTRY = "key long, made_in int, shard int, ordinal long, start long, n_tokens long"
BUCKETS = "bucket long, n_keys long, n_buckets long"


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _put(folder: str, name: str, parts: list[bytes]) -> None:
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    passing = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(passing) as out:
        for part in parts:
            out.write(part)
    store.move(passing, f"{path}/{name}")


# ---- minimal perfect hash -------------------------------------------------------------------------------------

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers for each seed."""
    x = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as booleans) for distinct keys; every key is alone on its bit in exactly one level."""
    levels, left = [], keys
    while len(left):
        size = max(64, BITS_PER_KEY * len(left))
        bit = mixed(left, len(levels)) % np.uint64(size)
        alone = np.bincount(bit.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        left = left[~alone[bit.astype(np.int64)]]
    return levels


def slots(keys: np.ndarray, levels: list[np.ndarray], ranks: list[np.ndarray]) -> np.ndarray:
    """Slot of each key. A key that was not in the build gets any slot, or -1."""
    out = np.full(len(keys), -1, np.int64)
    open_ = np.arange(len(keys))
    for n, (level, rank) in enumerate(zip(levels, ranks)):
        bit = (mixed(keys[open_], n) % np.uint64(len(level))).astype(np.int64)
        hit = level[bit]
        out[open_[hit]] = rank[bit[hit]]
        open_ = open_[~hit]
    return out


def level_ranks(levels: list[np.ndarray]) -> list[np.ndarray]:
    """For each bit, the set bits before it, over all levels."""
    before, out = 0, []
    for level in levels:
        total = np.cumsum(level)
        out.append(before + total - level)
        before += int(total[-1])
    return out


class Index:
    """The index file of one bucket."""

    def __init__(self, levels: list[np.ndarray], slot_columns: dict[str, np.ndarray]):
        self.levels, self.columns, self.ranks = levels, slot_columns, level_ranks(levels)

    @classmethod
    def of(cls, keys: np.ndarray, places: dict[str, np.ndarray]) -> Index:
        levels = build_levels(keys)
        order = np.empty(len(keys), np.int64)
        order[slots(keys, levels, level_ranks(levels))] = np.arange(len(keys))
        return cls(levels, {"fingerprint": fingerprints(keys)[order], **{k: v[order] for k, v in places.items()}})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, sizes=np.array([len(x) for x in self.levels], np.int64),
                 bits=np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)])), **self.columns)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Index:
        with np.load(io.BytesIO(raw)) as held:
            sizes, bits = held["sizes"], np.unpackbits(held["bits"]).astype(bool)
            levels = np.split(bits[:sizes.sum()], np.cumsum(sizes)[:-1])
            return cls(levels, {k: held[k] for k in held.files if k not in ("sizes", "bits")})

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the keys that are present, and their slots."""
        slot = slots(keys, self.levels, self.ranks)
        if not len(self.columns["fingerprint"]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        there = (slot >= 0) & (self.columns["fingerprint"][np.maximum(slot, 0)] == fingerprints(keys))
        return np.flatnonzero(there), slot[there]


# ---- writing --------------------------------------------------------------------------------------------------

def write(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int, id_col: str = "doc_id",
          text_col: str = "text", shard_bytes: int = SHARD_BYTES, keys_per_bucket: int = KEYS_PER_BUCKET) -> None:
    """Encode every whole text, append ``end_id``, and write shards, tables of places and the index to ``folder``."""
    spark, width = docs.sparkSession, id_width(tokenizer_path)
    item = np.dtype(width).itemsize
    schema = pa.schema(list(zip(["key", *PLACE], [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3])))

    def write_shards(batches):
        encoder, task = word_encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        keys, held, sizes, shard = [], [], [], 0

        def close():
            nonlocal keys, held, sizes, shard
            lengths = np.array(sizes, "<u8")
            absent = np.array([k is None for k in keys], "u1")
            stored = np.array([k or 0 for k in keys], "<i8")
            _put(folder, f"shard-{task:06d}-{shard:06d}.ids", [
                struct.pack(HEADER, MAGIC, item, 0, len(keys), int(lengths.sum())),
                absent.tobytes(), stored.tobytes(), lengths.tobytes(), *held])
            n = len(keys)
            rows = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([task] * n, pa.int32()), pa.array([shard] * n, pa.int32()),
                 pa.array(np.arange(n)), pa.array((np.cumsum(lengths) - lengths).astype(np.int64)),
                 pa.array(lengths.astype(np.int64))], schema=schema)
            keys, held, sizes, shard = [], [], [], shard + 1
            return rows

        size = 0
        for batch in batches:
            for key, raw in encoder.encode_batch(batch):
                ids = np.frombuffer(raw + end, "<u4").astype(width).tobytes()
                keys.append(key)
                held.append(ids)
                sizes.append(len(ids) // item)
                size += len(ids)
                if size >= shard_bytes:
                    yield close()
                    size = 0
        if keys:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    rows.repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("text"), F.length("text")).mapInArrow(
        write_shards, ENTRY).write.parquet(f"{folder}/entries")
    entries = read_entries(spark, folder)
    order = Window.orderBy("made_in", "shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard file
    (entries.groupBy("made_in", "shard").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("shard_tokens"))
     .withColumn("base", F.coalesce(F.sum("shard_tokens").over(order), F.lit(0))).write.parquet(f"{folder}/shards"))

    keyed = entries.where("key IS NOT NULL")
    buckets = max(1, -(-keyed.count() // keys_per_bucket))

    def write_index(frame):
        places = {c: frame[c].to_numpy() for c in PLACE}
        name = f"index-{int(frame['bucket'].iloc[0]):06d}.mph"
        _put(folder, name, [Index.of(frame["key"].to_numpy(), places).dump()])
        return frame[["bucket"]].head(1).assign(n_keys=len(frame), n_buckets=buckets)

    first = F.min(F.struct(*PLACE)).alias("first")
    (keyed.groupBy("key").agg(first).select(_bucket(buckets), "key", "first.*")
     .groupBy("bucket").applyInPandas(write_index, BUCKETS).write.parquet(f"{folder}/buckets"))
    repeated = keyed.groupBy("key").agg(first, F.count("*").alias("n_docs")).where("n_docs > 1")
    (keyed.join(repeated, "key").where(F.struct(*PLACE) != F.col("first")).select("key", *PLACE)
     .write.parquet(f"{folder}/repeats"))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("long").alias("bucket")


def read_entries(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(f"{folder}/entries")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard: made_in, shard, n_docs, shard_tokens, base (ids of all shards before it)."""
    return spark.read.parquet(f"{folder}/shards")


# ---- reading --------------------------------------------------------------------------------------------------

def find(keys: DataFrame, folder: str, *, key_col: str = "key") -> DataFrame:
    """Place of the first document of each distinct, present key, from the index: key and ``PLACE``."""
    spark = keys.sparkSession
    n_buckets = spark.read.schema(BUCKETS).parquet(f"{folder}/buckets").agg(F.max("n_buckets")).first()[0]
    if n_buckets is None:
        return spark.createDataFrame([], ENTRY)
    asked = keys.select(F.col(key_col).cast("long").alias("key")).where("key IS NOT NULL").distinct()

    def look_up(batches):
        number, index = None, None
        for batch in batches:
            bucket, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for b in np.unique(bucket):
                if b != number:
                    store, path = _store(folder)
                    name = f"{path}/index-{int(b):06d}.mph"
                    if store.get_file_info(name).type == pafs.FileType.NotFound:
                        continue  # no key of the corpus falls into this bucket
                    with store.open_input_stream(name) as raw:
                        number, index = b, Index.load(raw.read())
                wanted = key[bucket == b]
                found, slot = index.find(wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted[found]), *[pa.array(index.columns[c][slot]) for c in PLACE]],
                    names=["key", *PLACE])

    return asked.select(_bucket(n_buckets), "key").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        look_up, ENTRY)


def fetch(keys: DataFrame, folder: str, *, key_col: str = "key", payload: bool = True) -> DataFrame:
    """All documents of the distinct, present keys, read from the shards: see ``read_places``."""
    spark = keys.sparkSession
    more = spark.read.schema(ENTRY).parquet(f"{folder}/repeats")
    asked = keys.select(F.col(key_col).cast("long").alias("key"))
    return read_places(find(keys, folder, key_col=key_col).unionByName(more.join(asked, "key", "left_semi")), folder,
                       payload=payload)


def read_places(places: DataFrame, folder: str, *, payload: bool = True) -> DataFrame:
    """Documents at places: key, start (ids of all documents before it), n_tokens, ids_crc32, width, ids.

    ``ids`` is the raw slice of the file (null without ``payload``), ``width`` its bytes per id, and ``ids_crc32`` the unsigned
    crc32 of the ids as little-endian four-byte integers. Places are gone through shard by shard; of a shard
    only its keys and the wanted slices are read, neighbours in one go.
    """
    out = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids_crc32", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())])

    def read(batches):
        current, shard = None, None
        for batch in batches:
            for run in _neighbours(batch.to_pylist()):
                at = (run[0]["made_in"], run[0]["shard"])
                if at != current:
                    current, shard = at, _Shard(folder, *at)
                rows = {name: [] for name in out.names}
                begin = run[0]["start"]
                raw = shard.slice(begin, sum(r["n_tokens"] for r in run))
                for r in run:
                    if shard.keys[r["ordinal"]] != r["key"]:
                        continue  # an absent key with the fingerprint of another
                    low = (r["start"] - begin) * shard.item
                    ids = raw[low:low + r["n_tokens"] * shard.item]
                    crc = zlib.crc32(np.frombuffer(ids, f"<u{shard.item}").astype("<u4").tobytes())
                    for name, value in zip(out.names, (r["key"], r["base"] + r["start"], r["n_tokens"], crc, shard.item,
                                                       ids if payload else None)):
                        rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=out)

    bases = read_shards(places.sparkSession, folder).select("made_in", "shard", "base")
    return (places.select("key", *PLACE).join(bases, ["made_in", "shard"])
            .repartition("made_in", "shard").sortWithinPartitions("made_in", "shard", "start")
            .mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long, width int, ids binary"))


def _neighbours(rows: list[dict], most: int = 1 << 20):
    """Runs of documents that stand one after the other in a shard, of about ``most`` ids at most."""
    run, size = [], 0
    for row in rows:
        if run and (size >= most or (row["made_in"], row["shard"]) != (run[-1]["made_in"], run[-1]["shard"])
                    or row["start"] != run[-1]["start"] + run[-1]["n_tokens"]):
            yield run
            run, size = [], 0
        run.append(row)
        size += row["n_tokens"]
    if run:
        yield run


class _Shard:
    def __init__(self, folder: str, made_in: int, shard: int):
        store, path = _store(folder)
        self.file = store.open_input_file(f"{path}/shard-{made_in:06d}-{shard:06d}.ids")
        magic, self.item, _, n, _ = struct.unpack(HEADER, self.file.read_at(HEADER_BYTES, 0))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {made_in}, {shard}")
        absent = np.frombuffer(self.file.read_at(n, HEADER_BYTES), "u1")
        stored = np.frombuffer(self.file.read_at(8 * n, HEADER_BYTES + n), "<i8")
        self.keys = [None if a else k for a, k in zip(absent.tolist(), stored.tolist())]
        self.body = HEADER_BYTES + 17 * n

    def slice(self, start: int, n: int) -> bytes:
        return self.file.read_at(n * self.item, self.body + start * self.item)
