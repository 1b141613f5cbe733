"""Token ids of whole texts with the tokenizers library, remembered word by word.

For a tokenizer that ends its words at white space, the ids of a text are the ids of its ASCII-white-space
separated chunks in order. Natural text repeats its chunks, so each distinct chunk goes through the library
once per worker and the rest is a dictionary lookup. Two more steps make chunks repeat more often, and are
taken only where they provably change nothing: a text of Latin letters without a special token is put in lower
case (the tokenizer does the same), and punctuation between a letter and white space becomes a chunk of its own
(the tokenizer splits there anyhow). Arrow cuts the texts and tells their chunks apart, ``CHARACTERS_AT_ONCE`` at a time, so only
the distinct ones become Python objects. A worker's memory is bounded: at ``MOST_WORDS``
chunks a new table begins, into which the chunks of the last one move when they are met again; long chunks are not kept.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

MOST_WORDS = 250_000
ROWS_AT_ONCE = 64
CHARACTERS_AT_ONCE = 4_000_000
WORDS_OF_TEXT = 300  # new words that the library gets as one text
LONGEST_KEPT = 48  # bytes
# Beyond these characters lower case and canonical composition may depend on each other; "<|" may open a
# special token, which is matched before lower-casing.
NOT_SIMPLE = re.compile("[^\x00-įı-ɏ]|<\\|")
# A run of ASCII punctuation (apostrophes aside, they open contractions) between a letter and white space.
# Its first mark is tried before the letter that precedes it: a search for a set of characters is quicker.
MARKS_AFTER_LETTER = re.compile(r"[!-&(-/:-@\[-`{-~](?<=[a-zß-öø-ÿ].)[!-&(-/:-@\[-`{-~]*(?=[ \n])")
ONE_WORD = re.compile("[a-zß-öø-ÿā-į]+")

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids as little-endian unsigned 32-bit bytes. A null text is an empty one, with no ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.ends_word = np.zeros(self.vocabulary, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> dict[bytes, bytes]:
        """Words of letters only end in exactly one word-end token, so they are encoded in texts of many."""
        plain = [w for w in words if ONE_WORD.fullmatch(w)]
        found: dict[bytes, bytes] = {}
        for at in range(0, len(plain), WORDS_OF_TEXT):
            few = plain[at:at + WORDS_OF_TEXT]
            ids = self._ids([" ".join(few)])[0]
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(few):
                raw, begin = ids.tobytes(), 0
                for word, end in zip(few, (cuts * 4).tolist()):
                    found[word.encode()] = raw[begin:end]
                    begin = end
        rest = [w for w in words if w.encode() not in found]
        found.update((w.encode(), ids.tobytes()) for w, ids in zip(rest, self._ids(rest)))
        return found

    def encode(self, texts: Iterable[str | None]) -> Iterable[bytes]:
        waiting: list[str] = []
        size = 0
        for text in texts:
            waiting.append(spaced(text or ""))
            size += len(waiting[-1])
            if size >= CHARACTERS_AT_ONCE:
                yield from self._encode(waiting)
                waiting, size = [], 0
        yield from self._encode(waiting)

    def encode_batch(self, batch: pa.RecordBatch) -> Iterable[tuple[int | None, bytes]]:
        """(key, ids) for a batch of key and text, a few rows at a time."""
        few = (batch.column(1).slice(at, ROWS_AT_ONCE).to_pylist() for at in range(0, batch.num_rows, ROWS_AT_ONCE))
        return zip(batch.column(0).to_pylist(), self.encode(chain.from_iterable(few)))

    def _encode(self, texts: list[str]) -> Iterable[bytes]:
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        chunks = cut.flatten().cast(pa.large_binary()).dictionary_encode()
        ids = pa.array(self._look_up(chunks.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(chunks.indices)
        _, ends, raw = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[cut.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        for begin, end in zip(ends, ends[1:]):
            yield raw[begin:end].to_pybytes() if begin < end else b""

    def _look_up(self, wanted: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks."""
        found = list(map(self.known.get, wanted))
        missing = [word for word, ids in zip(wanted, found) if ids is None]
        if not missing:
            return found
        if len(self.known) + len(missing) > MOST_WORDS:
            self.older, self.known = self.known, {}
            missing = wanted
        unseen = []
        for word in missing:
            ids = self.older.get(word)
            if ids is None:
                unseen.append(word)
            else:
                self.known[word] = ids
        if unseen:
            self.known.update(self._learn([w.decode() for w in unseen]))
        found = list(map(self.known.__getitem__, wanted))
        for word in unseen:
            if len(word) > LONGEST_KEPT:
                del self.known[word]
        return found


def spaced(text: str) -> str:
    """The text with the two steps that make its chunks repeat, where they change nothing."""
    if "<|" not in text if text.isascii() else not NOT_SIMPLE.search(text):
        text = MARKS_AFTER_LETTER.sub(r" \g<0>", text.lower())
    return text


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def id_width(path: str) -> str:
    """Narrowest little-endian type that holds every id."""
    return "<u2" if word_encoder(path).vocabulary <= 1 << 16 else "<u4"
