"""Packing and token files against the tokenizers library on whole texts."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bitpack, packing
from tidemark.llm.tokens import TextEncoder, default_tokenizer


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAbéÉßïst'. ,\n\t \x1c\x85́İ<|>1")), max_size=60))
def test_chunks_equal_whole_texts(text):
    enc = _encoder()
    whole = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode(text.encode()), dtype="<u4").tolist() == whole


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbéÉßï'. ,\n(*9<|>"), max_size=70)), max_size=8), st.integers(1, 200))
def test_many_texts_at_once(texts, span):
    enc = _encoder()
    enc.span = span
    got = list(enc.encode_all(pa.array(texts, pa.string())))
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def _encoder(cache={}):
    if not cache:
        cache["e"] = TextEncoder(default_tokenizer(), span=25)
        assert cache["e"].by_chunk
    return cache["e"]


@pytest.mark.parametrize("text", ["<|endoftext|> a<|startoftext|>b", "it's we'll 'd", "Straße ÉCOLE naïve Ǆ ﬁ", "á ́b", "x y"])
def test_special_texts(text, library):
    assert np.frombuffer(_encoder().encode(text.encode()), dtype="<u4").tolist() == library(text)


@settings(deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_patterns_place_every_piece_once(histogram):
    slots = packing.shortest_pack_first(histogram, 64)
    used = Counter()
    for length, n in histogram.items():
        seq, off = slots.place(np.full(n, length), np.arange(n))
        for s, o in zip(seq.tolist(), off.tolist()):
            for k in range(o, o + length):
                used[s, k] += 1
    assert all(v == 1 for v in used.values()) and all(k < 64 for _, k in used)
    ends = Counter(s for s, _ in used)
    assert all((s, k) in used for s, n in ends.items() for k in range(n))       # gapless from 0
    assert sorted(ends) == list(range(len(ends)))


def test_little_padding():
    rng = np.random.default_rng(1)
    histogram = Counter(np.minimum(2048, rng.lognormal(5.5, 1, 20_000).astype(int) + 1).tolist())
    slots = packing.shortest_pack_first(histogram)
    total = sum(k * v for k, v in histogram.items())
    packs = int((slots.first_pack + slots.packs).max())
    assert total / (packs * 2048) > 0.99


def test_packing_awkward(spark, docs, none, library):
    pieces, places = packing.pack_documents(docs, max_len=64)
    got = places.collect()
    want = Counter()
    for doc, text, *_ in awkward_rows():
        ids = np.array(library(text) + [1], dtype="<u4")
        for at in range(0, len(ids), 64):
            part = ids[at:at + 64]
            want[doc, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    taken = Counter((r.sequence_id, k) for r in got for k in range(r.offset, r.offset + r.length))
    assert max(taken.values()) == 1 and max(k for _, k in taken) < 64
    sequences = packing.packed_sequences(pieces, places, max_len=64, pad_id=7).collect()
    crc = {(r.sequence_id, r.offset): (r.length, r.ids_crc32) for r in got}
    for s in sequences:
        assert len(s.ids) == 256
        for (seq, off), (n, c) in crc.items():
            if seq == s.sequence_id:
                assert zlib.crc32(bytes(s.ids)[4 * off:4 * (off + n)]) == c
        assert set(np.frombuffer(bytes(s.ids), dtype="<u4")[s.n_ids:].tolist()) <= {7}
    assert packing.pack_documents(none)[1].count() == 0


def test_equal_lengths_are_ranked_by_many_tasks(spark):
    pieces = spark.range(5000).selectExpr("id as piece_id", "0L as start", "7 as length")
    ranks = [r["rank"] for r in packing.ranked(pieces).collect()]
    assert sorted(ranks) == list(range(5000))


@settings(deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2 ** 32 - 1), max_size=200), st.data())
def test_bits_round_trip(bits, values, data):
    ids = np.array([v & ((1 << bits) - 1) for v in values], dtype=np.uint32)
    packed = bitpack.pack_bits(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    lo = data.draw(st.integers(0, len(ids)))
    hi = data.draw(st.integers(lo, len(ids)))
    assert bitpack.unpack_bits(packed, bits, lo, hi - lo).tolist() == ids[lo:hi].tolist()


def test_bits_for():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_token_files_awkward(spark, docs, none, library, tmp_path):
    path = str(tmp_path / "files")
    bitpack.write_token_files(docs, path, default_tokenizer())
    rows = sorted(awkward_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    stream, want = [], Counter()
    for doc, text, *_ in rows:
        ids = library(text) + [1]
        want[doc, len(stream), len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
        stream += ids
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32)
                   for r in bitpack.read_documents(spark, path, digest_only=True).collect()) == want
    for r in bitpack.read_documents(spark, path).collect():
        assert r.ids == stream[r.start:r.start + r.n_tokens]
    for lo, hi in ((0, 5), (17, 4000), (len(stream) - 3, len(stream)), (9, 9)):
        assert bitpack.read_range(spark, path, lo, hi).tolist() == stream[lo:hi]
    bitpack.write_token_files(none, path + "0", default_tokenizer())
    assert bitpack.read_documents(spark, path + "0").count() == 0
