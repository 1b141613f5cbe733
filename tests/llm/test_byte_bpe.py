"""Byte-level BPE against the public library."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tillhouse.llm import byte_bpe, queries

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.encoder(queries.BYTE_BPE, PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def unpacked(raw):
    return [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)]


def test_random_texts_as_the_library(bpe, library):
    rng = random.Random(7)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'s", "'", "é", "é", "1", "日本", "　", "🙂", "!", "...", "\x85", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        assert unpacked(bpe.ids(text)) == library.encode_ordinary(text), text


def test_random_bytes_as_the_merges(bpe):
    rng = random.Random(8)
    for _ in range(2000):
        piece = b"".join(rng.choices(bpe.tokens, k=rng.randint(1, 6))) + bytes(rng.choices(range(256), k=rng.randint(0, 4)))
        assert [bpe.tokens[i] for i in bpe.piece(piece)] == byte_bpe.merged(piece, bpe.ranks)


def test_every_character_is_in_the_class_of_the_library(bpe, library):
    for c in [*range(0, 0x3000), *range(0x3000, 0x110000, 61), *list(byte_bpe.stand_ins())[::50]]:
        if not 0xD800 <= c < 0xE000:
            text = "x{0}1{0}! {0}{0}a".format(chr(c))
            assert unpacked(bpe.ids(text)) == library.encode_ordinary(text), hex(c)


def test_long_runs_take_linear_time(bpe, library):
    for text in ("a" * 100_000, " " * 100_000, "ab" * 50_000, "é" * 50_000):
        assert unpacked(bpe.ids(text)) == library.encode_ordinary(text)


def test_the_tables_of_pieces_are_bounded(bpe, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_PIECES", 5)
    monkeypatch.setattr(byte_bpe, "MOST_PAIRS", 5)
    text = " ".join(f"word{i % 17} thing{i % 13}" for i in range(500))
    assert unpacked(bpe.ids(text)) == library.encode_ordinary(text)
    assert len(bpe.known) <= 5


def vocabulary(tmp_path, tokens):
    ranked = [bytes([b]) for b in range(256)] + tokens
    path = tmp_path / "ranks"
    path.write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(ranked)))
    return str(path)


def test_a_token_that_no_merges_make_is_a_whole_match_only(tmp_path):
    path = vocabulary(tmp_path, [b"ab", b"xyz", b"abab"])
    bpe = byte_bpe.ByteBpe(path, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for text in ("xyz", "xyza", "axyz xyz", "ababab", "aabab", "ab" * 7 + "xyz"):
        assert unpacked(bpe.ids(text)) == library.encode_ordinary(text)


def test_ranks_out_of_merge_order_are_an_error(tmp_path):
    with pytest.raises(ValueError, match="higher rank"):
        byte_bpe.ByteBpe(vocabulary(tmp_path, [b"abc", b"ab"]), PATTERN)
    with pytest.raises(ValueError, match="bytes"):
        (tmp_path / "few").write_text(base64.b64encode(b"a").decode() + " 0")
        byte_bpe.ByteBpe(str(tmp_path / "few"), PATTERN)


def test_query_against_the_library(spark, folder, docs, library):
    got = {r.doc_id: r for r in queries.op11_byte_bpe(spark, folder).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids, found = library.encode_ordinary(r.text or ""), got[r.doc_id]
        assert (found.n_tokens, found.ids_sha256, found.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())


def test_odd_rows(spark, odd_docs, no_docs, library):
    encoded = byte_bpe.encode(odd_docs, queries.BYTE_BPE, PATTERN)
    got = sorted((r.doc_id is None, r.doc_id, r.ids) for r in encoded.collect())
    assert got == sorted((r.doc_id is None, r.doc_id, library.encode_ordinary(r.text or "")) for r in odd_docs.collect())
    decoded = byte_bpe.decode(encoded, queries.BYTE_BPE, PATTERN).collect()
    assert sorted(bytes(r.bytes) for r in decoded) == sorted((r.text or "").encode() for r in odd_docs.collect())
    assert byte_bpe.encode(no_docs, queries.BYTE_BPE, PATTERN).collect() == []


def test_decoding_ids_of_any_kind(spark):
    rows = spark.createDataFrame([(1, [72, 105, 200]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.bytes for r in byte_bpe.decode(rows, queries.BYTE_BPE, PATTERN).collect()}
    tokens = byte_bpe.encoder(queries.BYTE_BPE, PATTERN).tokens
    assert got == {1: tokens[72] + tokens[105] + tokens[200], 2: b"", 3: None}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(rows.limit(0).union(spark.createDataFrame([(1, [60_000])], rows.schema)), queries.BYTE_BPE, PATTERN).collect()
