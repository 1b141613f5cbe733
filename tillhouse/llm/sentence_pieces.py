"""SentencePiece models run by the tokenizers library.

``read_model`` parses the model's protobuf: pieces with scores and types, the trainer's settings, the normaliser's. ``backend``
rebuilds it: the precompiled character map, removal of extra spaces, the dummy prefix and the space marker as normalisers;
unigram scores as they are, or for BPE the merges, every split of a piece into two pieces, best score first; bytes for
characters without a piece. Control, unknown and byte pieces can't be spelled out in a text, so under unigram, whose pieces are all
searched for, they are renamed to strings that no text holds.

``PieceEncoder`` encodes batches with the library's threads, as many as the task has cores. Where no piece reaches over the
start of a space run or over a line break, a text's ids are those of its segments in order; each segment is then encoded once per
worker and looked up afterwards, in tables of bounded size.

Defined results: a null text is an empty one, which has no ids; special strings in a text are ordinary text; unknown characters become
bytes if the model has them, else the unknown id; under a unigram
model with byte pieces a text that spells one out, like ``<0x0A>``, is taken at its word, where the original spells it in pieces; ids outside the vocabulary are an error when decoding; repeated rows are encoded each;
an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MOST_SEGMENTS = 700_000
LONGEST_KEPT = 48  # characters
TEXTS_AT_ONCE = 256
SEGMENT = re.compile(f"\\n|{MARK}*[^{MARK}\\n]+|{MARK}+")


# ---- the model file -------------------------------------------------------------------------------------------

@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    marker_behind: bool = False
    unknown_id: int = 0
    character_map: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[at] & 127) << shift
        shift += 7
        at += 1
        if raw[at - 1] < 128:
            return value, at


def _fields(raw: bytes):
    """(number, value) of a protobuf message: integers, or bytes for all else."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(raw, at)
        else:
            if kind == 2:
                size, at = _varint(raw, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"wire type {kind}")
            value, at = raw[at:at + size], at + size
        yield key >> 3, value


def read_model(raw: bytes) -> Model:
    """Fields by their numbers in the published sentencepiece_model.proto."""
    model = Model()
    for number, value in _fields(raw):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append(piece[1].decode())
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            model.algorithm = trainer.get(3, UNIGRAM)
            model.marker_behind = bool(trainer.get(24, 0))
            model.byte_fallback = bool(trainer.get(35, 0))
            model.unknown_id = trainer.get(40, 0)
        elif number == 3:
            rules = dict(_fields(value))
            model.character_map = rules.get(2, b"")
            model.dummy_prefix = bool(rules.get(3, 1))
            model.remove_extra_spaces = bool(rules.get(4, 1))
            model.escape_spaces = bool(rules.get(5, 1))
    if model.algorithm not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model.algorithm} is neither unigram nor BPE")
    if model.marker_behind:
        raise ValueError("space markers behind words are not supported")
    return model


# ---- the tokenizers backend -----------------------------------------------------------------------------------

def merges(model: Model) -> list[tuple[str, str]]:
    """Best score first. Pieces of one score grow from the left, so their longer left parts come first."""
    score = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k in (NORMAL, USER)}
    found = []
    for piece, value in score.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in score and right in score:
                found.append((-value, -len(left), left, right))
    return [(left, right) for _, _, left, right in sorted(found)]


def normaliser(model: Model) -> normalizers.Normalizer | None:
    steps = []
    if model.character_map:
        steps.append(normalizers.Precompiled(model.character_map))
    if model.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps) if steps else None


def backend(model: Model) -> Tokenizer:
    if model.algorithm == UNIGRAM:
        names = [p if k in (NORMAL, USER) or (k == BYTE and model.byte_fallback) else f"\0{p}"
                 for p, k in zip(model.pieces, model.kinds)]
        inner = models.Unigram(list(zip(names, model.scores)), unk_id=model.unknown_id, byte_fallback=model.byte_fallback)
    else:
        inner = models.BPE(vocab={p: i for i, p in enumerate(model.pieces)}, merges=merges(model),
                           unk_token=model.pieces[model.unknown_id], fuse_unk=True, byte_fallback=model.byte_fallback)
    made = Tokenizer(inner)
    if (rules := normaliser(model)) is not None:
        made.normalizer = rules
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    made.decoder = decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return made


def splits_at_segments(model: Model) -> bool:
    plain = not model.character_map and not model.remove_extra_spaces and model.escape_spaces
    usual = [p for p, k in zip(model.pieces, model.kinds) if k in (NORMAL, USER)]
    return (plain and model.dummy_prefix and model.algorithm == BPE and model.byte_fallback
            and not any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in usual))


def segments(text: str) -> list[str]:
    return SEGMENT.findall(text.replace(" ", MARK))


def is_plain(text: str) -> bool:
    return text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text


class Remembered:
    """Ids of strings, in two tables of at most ``MOST_SEGMENTS``: when one is full a new one begins, into which strings move
    when they are met again. Long strings are held only until the next call."""

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.long: list[str] = []

    def prepare(self, wanted: set[str], learn) -> None:
        """Makes ``known`` hold all of ``wanted``."""
        for text in self.long:
            self.known.pop(text, None)
        missing = wanted.difference(self.known)
        if len(self.known) + len(missing) > MOST_SEGMENTS:
            self.older, self.known, missing = self.known, {}, wanted
        unseen = []
        for text in missing:
            ids = self.older.get(text)
            if ids is None:
                unseen.append(text)
            else:
                self.known[text] = ids
        self.known.update(zip(unseen, learn(unseen)))
        self.long = [text for text in unseen if len(text) > LONGEST_KEPT]


class PieceEncoder:
    """``path`` is a SentencePiece model file; ``threads`` the cores of a task."""

    def __init__(self, path: str, threads: int = 1):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        with open(path, "rb") as file:
            self.model = read_model(file.read())
        self.tokenizer = backend(self.model)
        self.item = "<u2" if len(self.model.pieces) <= 1 << 16 else "<u4"
        self.segmented = splits_at_segments(self.model)
        self.segments = backend(self.model)
        self.segments.normalizer = normalizers.Sequence([])
        self.segments.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
        self.line_break = self.model.pieces.index("<0x0A>") if self.segmented else -1
        self.known, self.words = Remembered(), Remembered()
        self.spelled = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode()
                        for p, k in zip(self.model.pieces, self.model.kinds)]

    def _raw(self, tokenizer: Tokenizer, texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.item).tobytes() for e in found]

    def _learn(self, segments: list[str]) -> list[bytes]:
        """Ids of segments, which are encoded as the lines of one text; a segment that is a line break has no line of its own."""
        lines = [s for s in segments if s != "\n"]
        raw = self._raw(self.segments, ["\n".join(lines)])[0] if lines else b""
        item = int(self.item[2])
        cuts = [at * item for at in np.flatnonzero(np.frombuffer(raw, self.item) == self.line_break).tolist()]
        assert len(cuts) == max(0, len(lines) - 1)
        held = dict(zip(lines, (raw[a:b] for a, b in zip([0, *(c + item for c in cuts)], [*cuts, len(raw)]))))
        held["\n"] = np.array([self.line_break], self.item).tobytes()
        return [held[s] for s in segments]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text, little-endian, ``item`` wide."""
        texts = [t or "" for t in texts]
        if not self.segmented:
            return [r if t else b"" for t, r in zip(texts, self._raw(self.tokenizer, texts))]
        out: list[bytes] = [b""] * len(texts)
        plain = [k for k, t in enumerate(texts) if t and is_plain(t)]
        other = [k for k, t in enumerate(texts) if t and not is_plain(t)]
        for k, ids in zip(plain, self._by_words([texts[k].split(" ") for k in plain])):
            out[k] = ids
        for k, ids in zip(other, self._by_segments([segments(f" {texts[k]}") for k in other])):
            out[k] = ids
        return out

    def _by_words(self, cut: list[list[str]]) -> list[bytes]:
        """For texts whose spaces all stand alone between words: each word is encoded with the space before it."""
        self.words.prepare(set().union(*cut), self._learn_words)
        return [b"".join(map(self.words.known.__getitem__, words)) for words in cut]

    def _learn_words(self, words: list[str]) -> list[bytes]:
        lines = [w for w in words if "\n" not in w]
        found = dict(zip(lines, self._learn([MARK + w for w in lines])))
        broken = [w for w in words if "\n" in w]
        found.update(zip(broken, self._by_segments([segments(f" {w}") for w in broken])))
        return [found[w] for w in words]

    def _by_segments(self, cut: list[list[str]]) -> list[bytes]:
        self.known.prepare(set().union(*cut), self._learn)
        return [b"".join(map(self.known.known.__getitem__, parts)) for parts in cut]

    def normalised(self, texts: list[str]) -> list[str]:
        """What decoding should give back: the texts as the model's normaliser leaves them."""
        if self.segmented:
            return [t.replace(MARK, " ") if MARK in t else t for t in texts]
        rules = self.tokenizer.normalizer
        out = [rules.normalize_str(t).replace(MARK, " ") if t and rules else t for t in texts]
        return [t[1:] if self.model.dummy_prefix and t[:1] == " " else t for t in out]

    def decode(self, raw: Iterable[bytes]) -> list[str]:
        """Texts of id sequences as ``encode`` makes them. Sequences whose pieces spell UTF-8 are looked up; others, with bytes that
        are no character, go through the library's decoder."""
        out = []
        for ids in (np.frombuffer(r, self.item).tolist() for r in raw):
            try:
                text = b"".join([self.spelled[i] for i in ids]).decode()
                out.append(text[1:] if self.model.dummy_prefix and text[:1] == " " else text)
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode(ids, skip_special_tokens=False))
        return out


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}
_ORIGINALS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def piece_encoder(path: str, threads: int = 1) -> PieceEncoder:
    if (path, threads) not in _ENCODERS:
        _ENCODERS[path, threads] = PieceEncoder(path, threads)
    return _ENCODERS[path, threads]


def original(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _ORIGINALS:
        _ORIGINALS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _ORIGINALS[path]


# ---- over tables ----------------------------------------------------------------------------------------------

def _threads(df: DataFrame) -> int:
    return int(df.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           verify: bool = False) -> DataFrame:
    """One row per document: id_col, n_pieces, width (bytes per id), ids. With ``verify`` also ids_crc32 (of the ids as four-byte
    integers), parity (the sentencepiece library gives the same ids) and round_trip (the ids decode to the text)."""
    threads = _threads(docs)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_pieces", T.LongType()),
              T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())]
    if verify:
        fields += [T.StructField("ids_crc32", T.LongType()), T.StructField("parity", T.BooleanType()),
                   T.StructField("round_trip", T.BooleanType())]

    def run(batches):
        encoder = piece_encoder(model_path, threads)
        width = int(encoder.item[2])
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = encoder.encode(texts)
                columns = [batch.column(0), pa.array([len(i) // width for i in ids], pa.int64()),
                           pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())]
                if verify:
                    wide = [np.frombuffer(i, encoder.item).astype("<u4").tobytes() for i in ids]
                    same = [np.array(o, "<u4").tobytes() == w
                            for o, w in zip(original(model_path).encode(texts, num_threads=threads), wide)]
                    plain = encoder.normalised(texts)
                    columns += [pa.array([zlib.crc32(w) for w in wide], pa.int64()), pa.array(same, pa.bool_()),
                                pa.array([a == b for a, b in zip(encoder.decode(ids), plain)], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, model_path: str, *, id_col: str = "doc_id") -> DataFrame:
    """id_col and text of what ``encode`` gave."""
    threads = _threads(encoded)

    def run(batches):
        encoder = piece_encoder(model_path, threads)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder.decode(batch.column(1).to_pylist()))],
                                                 names=[id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(
        run, T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType), T.StructField("text", T.StringType())]))
