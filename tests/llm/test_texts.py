"""Quality rules, license scans, sentence pieces, language-model scores."""

import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import brute
from conftest import ODD_TEXTS
from tillhouse.llm import licenses, lm_scores, quality, queries, sentence_pieces, text_stats

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---- quality rules ----

def test_text_stats():
    draw = random.Random(3)
    texts = [*ODD_TEXTS] + [" ".join(draw.choices("ab#", k=draw.randint(0, 60))) + "\n" * draw.randint(0, 2) + "x\nx" for _ in range(200)]
    texts += [" ".join(["a b c d e f g h"] * 2), " ".join("abcdefgh" * 3)]
    for text in texts:
        assert text_stats.text_stats(text) == brute.text_stats(text), repr(text)


def test_op3_base_columns(spark, folder, docs):
    got = {r.doc_id: r for r in queries.op3_quality_rules(spark, folder).collect()}
    for r in docs.collect():
        n, chars, symbols, lines, repeated = brute.text_stats(r.text)
        found = got[r.doc_id]
        assert (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words) == (
            n, chars, symbols, lines, repeated)
        assert found.base_failed == (n < 20 or 100 * repeated > 30 * n)
        assert not (found.base_failed and found.kept)


def test_op3_rejects_low_quality_and_keeps_good_documents(spark):
    folder = "/root/testdata/sf0.01"  # 28 low and 333 good labelled documents pass the fixed rules there
    verdicts = queries.op3_quality_rules(spark, folder).where("NOT base_failed").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("quality").pivot("kept", [True, False]).count()
    found = {r.quality: (r["true"] or 0, r["false"] or 0) for r in verdicts.collect()}
    assert found[1][0] > 300 and found[1][1] == 0
    assert found[0][1] > 20 and found[0][0] <= 2


def plain_mcd(x, support=quality.SUPPORT):
    """The same estimate in one place, with exact ranks."""
    p, floor = x.shape[1], np.diag(np.square(quality.FLOOR))
    middle = np.median(x, 0)
    spread = 1.4826 * np.median(np.abs(x - middle), 0)
    center, precision, last = middle, np.linalg.inv(np.diag(spread**2) + floor), None
    for _ in range(quality.MOST_STEPS):
        z = x - center
        d = np.einsum("ij,jk,ik->i", z, precision, z)
        near = x[d <= np.sort(d)[math.ceil(support * len(x)) - 1]]
        cov = quality.consistency(support, p) * np.cov(near.T, bias=True) + floor
        center, precision = near.mean(0), np.linalg.inv(cov)
        total = np.linalg.slogdet(cov)[1]
        if last is not None and last - total < 1e-6 * max(1.0, abs(last)):
            break
        last = total
    z = x - center
    near = x[np.einsum("ij,jk,ik->i", z, precision, z) <= quality.chi2_quantile(0.975, p)]
    return near.mean(0), quality.consistency(0.975, p) * np.cov(near.T, bias=True) + floor


def test_robust_outliers_against_one_place(spark):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefg", k=draw.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(600):
        text = draw.choices(words, k=int(40 * 10 ** draw.random()))
        if i % 12 == 0:
            text = [w + "%%%" for w in text]
        rows.append((i, " ".join(text), "en", "hot" if i % 3 else "cold"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for source in ("hot", "cold"):
        ids = [i for i, _, _, s in rows if s == source]
        stats = np.array([brute.text_stats(rows[i][1]) for i in ids], float)
        n = stats[:, 0]
        x = np.c_[np.log(n), stats[:, 1] / n, np.log1p(100 * stats[:, 2] / n), np.log1p(1000 * stats[:, 3] / n), stats[:, 4] / n]
        center, cov = plain_mcd(x)
        z = x - center
        distance = np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z)
        found = np.array([got[i].distance for i in ids])
        assert np.allclose(found, distance, rtol=0.05, atol=0.05)
        verdict = distance <= quality.chi2_quantile(1 - quality.REJECT_P, x.shape[1])
        assert [got[i].kept for i in ids] == verdict.tolist()
    assert [i for i in got if not got[i].kept] == [i for i in got if i % 12 == 0]


def test_quality_of_odd_rows(odd_docs, no_docs):
    rows = quality.judge(odd_docs).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter(
        (r.doc_id, brute.text_stats(r.text)[0]) for r in odd_docs.collect())
    whole = quality.judge(odd_docs, whole_rows=True)
    assert whole.select("row.*").dtypes == odd_docs.dtypes and whole.count() == odd_docs.count()
    assert quality.judge(no_docs).count() == 0


# ---- license scans ----

@pytest.mark.parametrize("text, ids, permissive", [
    ("MIT", {"mit"}, True), ("GPL-2.0-only", {"gpl-2.0"}, False), ("MIT OR GPL-3.0", {"mit", "gpl-3.0"}, True),
    ("MIT AND GPL-3.0", {"mit", "gpl-3.0"}, False), ("GPL-2.0 OR MIT AND BSD-3-Clause", {"gpl-2.0", "mit", "bsd-3-clause"}, True),
    ("(GPL-2.0 OR MIT) AND GPL-3.0", {"gpl-2.0", "mit", "gpl-3.0"}, False),
    ("Apache-2.0 WITH LLVM-exception", {"apache-2.0", "llvm-exception"}, True), ("mit or gpl-2.0+", {"mit", "gpl-2.0"}, True),
])
def test_expressions(text, ids, permissive):
    assert licenses.evaluate(text) == licenses.Value(frozenset(ids), permissive)


@pytest.mark.parametrize("text", ["", "(", ")", "MIT OR", "OR MIT", "MIT GPL", "(MIT", "MIT)", "()", "MIT ; GPL", "MIT AND OR BSD"])
def test_broken_expressions(text):
    assert licenses.evaluate(text) is None


@pytest.mark.parametrize("text, start", [
    ("MIT. See the file.", "MIT"), ("MIT, see LICENSE", "MIT"), ("(MIT OR Apache-2.0) and more text", "(MIT OR Apache-2.0)"),
    ("GPL-2.0+ OR (MIT AND ISC) WITH care", "GPL-2.0+ OR (MIT AND ISC)"), ("Apache-2.0 WITH LLVM-exception.", "Apache-2.0 WITH LLVM-exception"),
    ("MIT OR", "MIT"), ("(MIT", ""), ("MIT) x", "MIT"), ("what is this", ""), ("mit or isc", "mit or isc"), (";", ""), ("", ""), ("MIT GPL-3.0", "MIT"),
    ("((MIT) OR (ISC OR BSD-3-Clause", "")])
def test_expressions_before_prose(text, start):
    assert licenses.leading_expression(text) == start
    assert not start or licenses.evaluate(start) is not None


def test_the_longest_expression_is_taken():
    rng = random.Random(4)
    for _ in range(3000):
        text = " ".join(rng.choices(["MIT", "ISC", "GPL-2.0", "OR", "AND", "WITH", "(", ")", "prose", ","], [4, 2, 2, 3, 2, 1, 2, 2, 1, 1], k=rng.randint(0, 9)))
        parts = text.split(" ")
        starts = [" ".join(parts[:n]) for n in range(len(parts), 0, -1) if not {"prose", ","} & set(parts[:n])]
        assert licenses.leading_expression(text) == next((s for s in starts if licenses.evaluate(s) is not None), ""), text


def test_labels_and_score_of_tags_in_sentences(spark):
    texts = ["SPDX-License-Identifier: MIT. See the file.", "spdx-license-identifier: MIT, see LICENSE", "SPDX-License-Identifier: (MIT OR Apache-2.0) and more text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.summary(licenses.scan_licenses(docs)).collect()}
    assert got == {0: ("mit", 1.0), 1: ("mit", 1.0), 2: ("apache-2.0,mit", 1.0)}


def test_op4_base_columns(spark, folder, docs):
    got = {r.doc_id: r for r in queries.op4_license_scan(spark, folder).collect()}
    for r in docs.collect():
        n, places = brute.phrase_places(r.text, licenses.BASE_PHRASES)
        found = got[r.doc_id]
        assert (found.n_words, found.n_base, found.base_labels) == (n, len(places), ",".join(sorted({x for _, x in places})))
        assert (found.first_word, found.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert 0 <= found.score <= 1 and set(found.base_labels.split(",")) - {""} <= set(found.labels.split(","))


def test_license_scan_of_hard_cases(spark):
    texts = ["# SPDX-License-Identifier: (MIT OR GPL-2.0-only)\nMIT license mit license", "cc by sa cc-by cc by", None, "",
             "/* SPDX-License-Identifier: Apache-2.0 */", "spdx-license-identifier: what is this", "SPDX-License-Identifier:",
             "İSPDX-License-Identifier: ISC", "the GNU general\npublic LICENSE, Apache\x00License", "mit licenses amit license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.summary(licenses.scan_licenses(docs)).collect()}
    for i, text in enumerate(texts):
        n, places = brute.phrase_places(text, licenses.BASE_PHRASES)
        assert (rows[i].n_words, rows[i].n_base) == (n, len(places))
    assert rows[0].labels == "gpl-2.0,mit" and rows[0].score == 1.0
    assert rows[1].labels == "cc-by,cc-by-sa" and rows[4].labels == "apache-2.0"
    assert rows[5].labels == "unparsed" and rows[5].score == 0.0 and rows[6].labels == ""
    assert rows[7].labels == "isc" and rows[8].labels == "apache,gpl"


def test_license_scan_of_odd_rows(odd_docs, no_docs):
    assert licenses.summary(licenses.scan_licenses(odd_docs)).count() == odd_docs.count()
    assert licenses.summary(licenses.scan_licenses(no_docs)).count() == 0


# ---- sentence pieces ----

def message(*fields):
    """A protobuf message of (number, value)."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_file(folder, byte_fallback, extra_spaces):
    """A hand-made unigram model; nothing is trained."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, -float(k + 1), 1) for k, p in enumerate(
        ["▁the", "▁a", "▁", "the", "in", "▁in", "a", "b", "t", "h", "e", "n", "i", "s", "ab", "ba", "▁b", "<", ">", "/"])]
    raw = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    raw += message((2, message((3, 1), (35, int(byte_fallback)), (40, 0))))
    raw += message((3, message((1, b"identity"), (3, 1), (4, int(extra_spaces)), (5, 1))))
    path = folder / f"unigram-{byte_fallback}-{extra_spaces}.model"
    path.write_bytes(raw)
    return str(path)


@pytest.mark.parametrize("kind", ["bpe", "unigram", "unigram bytes", "unigram spaces"])
def test_parity_with_sentencepiece(kind, tmp_path, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MOST_SEGMENTS", 30)
    path = PIECES if kind == "bpe" else unigram_file(tmp_path, "bytes" in kind, "spaces" in kind)
    encoder, library = sentence_pieces.PieceEncoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert encoder.segmented == (kind == "bpe")
    draw = random.Random(2)
    parts = ["a", "b", "the", " ", "  ", "in", "th", "ab", "<s>", "</s>", "s"]
    if kind == "bpe" or "bytes" in kind:
        parts += ["\n", "\t", "é", "é", "🙂", "日本", "▁", "▁▁", " " * 17, "<unk>", "ﬁ"]
    if kind == "bpe":
        parts.append("<0x0A>")
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(1500)]
    ids = encoder.encode(texts)
    for text, raw in zip(texts, ids):
        assert np.frombuffer(raw, encoder.item).tolist() == library.encode(text), repr(text)
    assert encoder.decode(ids) == encoder.normalised(texts)
    if kind == "bpe":
        assert encoder.decode(ids) == [library.decode(library.encode(t)) for t in texts]
        broken = np.array([3 + 0xE6, 3 + 0x97, 300], encoder.item).tobytes()  # a character cut in two
        assert "�" in encoder.decode([broken])[0]


def test_op2_against_sentencepiece(spark, folder, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in queries.op2_sentence_pieces(spark, folder).collect()}
    for r in docs.collect():
        ids = library.encode(r.text or "")
        assert (got[r.doc_id].n_pieces, got[r.doc_id].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert all(r.parity and r.round_trip for r in got.values())


def test_sentence_pieces_of_odd_rows(odd_docs, no_docs):
    encoded = sentence_pieces.encode(odd_docs, PIECES, verify=True)
    assert all(r.parity and r.round_trip for r in encoded.collect())
    back = sentence_pieces.decode(encoded, PIECES).collect()
    assert Counter(map(tuple, back)) == Counter((r.doc_id, r.text or "") for r in odd_docs.collect())
    assert sentence_pieces.encode(no_docs, PIECES).count() == 0


# ---- language-model scores ----

def backoff_scores(rows):
    grams = {}
    for k, (_, text) in enumerate(rows):
        words = (text or "").encode().lower().split()
        grams[k] = words, Counter(tuple(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    total, size, out = Counter(), 0, []
    for words, own in grams.values():
        total.update(own)
        size += len(words)
    for words, own in grams.values():
        rest, score = max(size - len(words), 1), 0.0
        for k, w in enumerate(words):
            def outside(*g):
                return total[g] - own[g]
            if k > 1 and outside(*words[k - 2:k + 1]):
                s = outside(*words[k - 2:k + 1]) / outside(*words[k - 2:k])
            elif k and outside(*words[k - 1:k + 1]):
                s = (0.4 if k > 1 else 1) * outside(*words[k - 1:k + 1]) / outside(words[k - 1])
            else:
                s = 0.4 ** min(k, 2) * max(outside(w), 0.5) / rest
            score += math.log(s)
        out.append((len(words), score))
    return out


def test_op10_against_counters(spark, folder, docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = dict(zip((i for i, _ in rows), backoff_scores(rows)))
    for got, near in ((queries.op10_stupid_backoff(spark, folder).collect(), 1e-4),
                      (lm_scores.stupid_backoff(docs.repartition(7), ngrams_per_range=9000).collect(), 1e-6)):
        assert len(got) == len(rows)
        for r in got:
            assert r.n_words == want[r.doc_id][0] and r.log_score == pytest.approx(want[r.doc_id][1], rel=1e-9, abs=near)


def test_scores_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = Counter((i, n, round(s, 6)) for (i, _), (n, s) in zip(rows, backoff_scores(rows)))
    got = lm_scores.stupid_backoff(odd_docs).collect()
    assert Counter((r.doc_id, r.n_words, round(r.log_score, 6)) for r in got) == want
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)
    assert lm_scores.stupid_backoff(no_docs).count() == 0


def test_large_ids_stay_beside_unknown_ones(spark):
    rows = spark.createDataFrame([(2**62 + 1, "a b"), (None, "a b c"), (2**62 + 3, None)], "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.n_words) for r in lm_scores.stupid_backoff(rows).collect()} == {(2**62 + 1, 2), (None, 3), (2**62 + 3, 0)}


def test_chunks_stay_where_they_are(spark, docs, monkeypatch):
    want = {r.doc_id: r.log_score for r in lm_scores.stupid_backoff(docs).collect()}
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 20_000)  # many chunks a home
    got = lm_scores.stupid_backoff(docs)
    assert {r.doc_id: r.log_score for r in got.collect()} == pytest.approx(want)
    assert {t.name for t in spark.catalog.listTables()} == before
    plan = got._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FlatMapCoGroupsInPandas"):].split("Exchange")[0]
    assert "Bucketed: true" in left  # no exchange between the stored texts and the scoring


def test_counts_and_hashes_pack_exactly():
    counts = np.array([1, 254, 255, 256, 10**12, 0])
    assert (lm_scores._unpack_counts(*lm_scores._pack_counts(counts)) == counts).all()
    for hashes in ([5, 9, 2**47], [3, 4, 5], []):
        held = np.array(hashes, np.uint64)
        assert (lm_scores._unpack(*lm_scores._pack(held)) == held).all()


def test_ngrams_with_near_hashes_are_told_apart():
    def unmixed(x):  # the words whose unigrams get these hashes
        def shifted(x, by):
            return x ^ x >> by ^ (x >> 2 * by if 2 * by < 64 else 0)
        x = shifted(x, 31) * pow(0x94D049BB133111EB, -1, 1 << 64) % (1 << 64)
        x = shifted(x, 27) * pow(0xBF58476D1CE4E5B9, -1, 1 << 64) % (1 << 64)
        return (shifted(x, 30) - 1) * pow(int(lm_scores._MULTIPLIERS[1, 0]), -1, 1 << 64) % (1 << 64)

    words = np.array([unmixed(1 << 60), unmixed((1 << 60) + 1)], np.uint64)  # equal in their first 48 bits
    grams, _ = lm_scores._ngrams(words, np.array([1, 1]))
    assert len(set(grams.tolist())) == 2
    for hashes in ([5, 2**40, 2**62], [7, 2**40], [2**64 - 1]):
        held = np.array(hashes, np.uint64)
        assert (lm_scores._unpack(*lm_scores._pack(held)) == held).all()
