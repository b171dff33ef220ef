"""BPE and packing against the tokenizers library."""

import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tubetrace.llm import bpe, common, packing

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


LIB, LIB_WORDS = library(BYTES), library(WORDS)
TEXT = st.text(st.one_of(st.sampled_from(" \n\t.,'sdItre09é你́  \x1c"), st.characters(exclude_categories=["Cs"])))


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_ids_and_round_trip(text):
    codec = bpe.codec(BYTES)
    ids = LIB.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids
    assert codec.decode(ids) == LIB.decode(ids, skip_special_tokens=False) == text


def test_cuts_are_certain():
    codec = bpe.codec(BYTES)
    assert b"".join(codec.fragments(b"x\xe4\xbd\xa0" * 50)) == b"x\xe4\xbd\xa0" * 50
    for left, right in (p for p in [(b"e", b" ")] if not codec.joined[p[0][0], p[1][0]]):
        assert not any(left + right in t for t in codec.token.values())


def test_broken_utf8_decodes_like_the_library():
    ids = [LIB.token_to_id("Ã"), LIB.token_to_id("a")]
    assert bpe.codec(BYTES).decode(ids) == LIB.decode(ids, skip_special_tokens=False)


def test_documents(odd, none):
    rows = bpe.encode_documents(odd, BYTES, digest=True).collect()
    assert len(rows) == odd.count()
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    for r in rows:
        ids = next(LIB.encode(t or "", add_special_tokens=False).ids for i, t in texts if i == r.doc_id)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest())
    plain = bpe.encode_documents(odd, BYTES).collect()
    assert all(r.decoded == next(t or "" for i, t in texts if i == r.doc_id) for r in plain)
    assert bpe.encode_documents(none, BYTES).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_word_ids(texts):
    want = [LIB_WORDS.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.word_ids(WORDS)(texts)] == want


def test_word_ids_merge_words_with_marks_without_the_whole_tokenizer(monkeypatch):
    encode, whole = packing.WordIds(WORDS, 3), []
    plain = encode._encode
    monkeypatch.setattr(encode, "_encode", lambda runs: whole.extend(runs) or plain(runs))
    texts = ["Fine... (word)", "", " Été&&& fine... é\x1c x\n", "it's 2 Été&&&", "<|endoftext|> one% ONE%"] * 2
    want = [LIB_WORDS.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(3):  # the runs outlive their span only where they come again
        for at in (0, 2, 5):
            found = encode(texts[at:])
            assert [np.frombuffer(b, "<u4").tolist() for b in found] == want[at:]
    assert encode([]) == [] and len(encode.known) + len(encode.old) < 40
    assert {"(word)", "it's", "<|endoftext|>"} <= set(whole)
    assert not set(whole) & {"Fine...", "Été&&&", "fine...", "one%", "ONE%", "x"}


def test_portions_hold_all_rows(monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 10)
    rows = pa.array(["abc", None, "abcdefgh", "x" * 50, "", "a"])
    found = common.portions(rows)
    assert [k for a, n in found for k in range(a, a + n)] == [*range(6)] and len(found) > 2
    assert common.portions(rows[:0]) == []


def test_packing(odd, none):
    rows = packing.pack_documents(odd, WORDS, capacity=64).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    by_sequence = {}
    for r in rows:
        ids = [*LIB_WORDS.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        part = ids[r.start:r.start + r.length]
        assert r.start == 64 * r.piece and len(part) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 64
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 64) + 1
    assert packing.pack_documents(none, WORDS).count() == 0


def test_pieces_are_packed_online_in_hash_order(spark_llm):
    rng = np.random.default_rng(6)
    items = spark_llm.createDataFrame(
        [(i, int(n)) for i, n in enumerate(rng.integers(1, 60, 300))], "doc_id long, length long")
    rows = packing.pack(items, 1, capacity=64, open_bins=8).withColumn(
        "order", F.xxhash64("doc_id", "length")).collect()
    bins = packing.BestFit(64, 8)
    for r in sorted(rows, key=lambda r: r.order):
        assert (r.sequence_id, r.offset) == bins.place(r.length)
    assert packing.DOCS_PER_PARTITION > 10 * packing.OPEN_BINS


def test_fullest_bin_closes_first():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # closes 1, then 0 stays
    assert bins.place(4) == (0, 6)
    assert bins.place(3) == (3, 0)
    assert bins.place(2) == (2, 8)
