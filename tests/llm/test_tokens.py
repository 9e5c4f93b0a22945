"""Operators 3, 5 and 6: ids by the library, exact round trips, whole offsets."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import bpe, packing, separators, token_files
from tests.llm.data import SCHEMA, awkward, real

PATH = bpe.tokenizer_path()


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(PATH)


def test_special_token_strings_as_the_library_gives_them(spark):
    fresh = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "no <|endoftext> here", "", None]
    ids = [fresh.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in read_back(spark, rows)}
    start = 0
    for k, want in enumerate(ids):
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(want) + 1, crc([*want, 2]))
        start += len(want) + 1
    pieces = packing.concatenate_and_cut(spark.createDataFrame(rows, SCHEMA), PATH, 0).collect()
    assert {p.doc_id: (p.doc_tokens, p.ids_crc32) for p in pieces} == {k: (len(x) + 1, crc([*x, 0])) for k, x in enumerate(ids)}


def whole(enc, text):
    return enc.tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sZ9 \n\t\x85\xa0!.é漢\x1c\x1f　​|<>"), max_size=30))
def test_pieces_equal_whole_text(text):
    enc = bpe.encoder(PATH)
    assert enc.encode([text])[0].tolist() == whole(enc, text)


def test_pieces_equal_whole_text_on_documents(enc):
    texts = [t for _, t in real()] + [t or "" for _, t in awkward()] + ["<|endoftext|> a <|endoftext|>"]
    assert [x.tolist() for x in enc.encode(texts)] == [whole(enc, t) for t in texts]


def test_a_full_cache_changes_nothing(enc, monkeypatch):
    monkeypatch.setattr(bpe, "_CACHE_PIECES", 20)
    fresh = bpe.Encoder(PATH)
    texts = [t for _, t in real(40)]
    assert [x.tolist() for x in fresh.encode(texts)] == [whole(enc, t) for t in texts]
    assert len(fresh.memo) <= 20


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 700), st.integers(0, 2**31))
def test_segment_round_trip_and_random_access(bits, n, seed):
    r = np.random.default_rng(seed)
    ids = r.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
    cut = sorted(r.integers(0, n + 1, 2).tolist())
    docs = np.split(ids, cut)
    seg = token_files.Segment(token_files.pack_segment([3, -1, 9], docs, bits, block=128))
    assert seg.ids().tolist() == ids.tolist()
    assert seg.doc_ids.tolist() == [3, -1, 9]
    a, b = cut
    assert seg.ids(a, b).tolist() == ids[a:b].tolist()


def test_width_and_overflow():
    assert [token_files.width(v) for v in (1, 2, 3, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 17]
    with pytest.raises(ValueError):
        token_files.pack_segment([1], [np.array([8], dtype="<u4")], 3)


def read_back(spark, rows, schema=SCHEMA):
    return token_files.packed_token_files(spark.createDataFrame(rows, schema), PATH, 2).collect()


def test_token_files(spark, enc):
    rows = awkward()
    got = sorted(read_back(spark, rows), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(d for d, _ in rows)
    start, texts = 0, dict(rows)
    for r in got:
        ids = [*whole(enc, texts[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_null_ids_repeats_empty_table_and_clashing_columns(spark):
    rows = [(None, "b"), (1, "x"), (1, "x"), (1, None), (None, "a")]
    got = sorted(read_back(spark, rows), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 1, 1]
    assert read_back(spark, []) == []
    clash = spark.createDataFrame([(7, "hi", 1, "z")], SCHEMA + ", part int, data string")
    assert [r.doc_id for r in token_files.packed_token_files(clash, PATH, 2).collect()] == [7]


def check_pieces(pieces, texts, enc, window):
    """Every id once, sequences gapless and full but the last."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for d, text in texts.items():
        ids, at = [*whole(enc, text), 0], 0
        for p in sorted(by_doc[d], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), crc(ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, own in by_seq.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or s == len(by_seq) - 1


@pytest.mark.parametrize("window", [16, 1024])
def test_packing(spark, enc, window):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA + "").repartition(5)
    check_pieces(packing.concatenate_and_cut(df, PATH, 0, window).collect(), dict(rows), enc, window)


def test_packing_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.concatenate_and_cut(empty, PATH, 0).collect() == []
    rows = spark.createDataFrame([(None, None, 1), (4, "a", 2), (4, "a", 3)], SCHEMA + ", start int")
    got = packing.concatenate_and_cut(rows, PATH, 0).collect()
    assert sorted((r.doc_id is None, r.length) for r in got) == [(False, 2), (False, 2), (True, 1)]


@pytest.mark.parametrize("block_bytes", [8, 64, 1 << 20])
def test_separator_scan_names_every_document(spark, enc, block_bytes, monkeypatch):
    monkeypatch.setattr(separators, "BLOCKS_PER_GROUP", 4)
    rows = [(d, t and t[:300]) for d, t in awkward()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    blocks = separators.flat_files(df, PATH, 50256, block_bytes)
    got = separators.separator_scan(blocks, 50256).collect()
    assert all(r.closed for r in got)
    assert {r.doc_id: r.n_tokens for r in got} == {d: len(whole(enc, t)) for d, t in rows}
    for f in {r.file_id for r in got}:
        own = sorted((r.start, r.n_tokens) for r in got if r.file_id == f)
        assert own[0][0] == 0 and all(a + n + 1 == b for (a, n), (b, _) in zip(own, own[1:], strict=False))


def test_separator_scan_brute_force(spark):
    """Random files without doc_ids, some ending in an open document."""
    r = random.Random(5)
    files = {f: [r.choice([9, 9, 0, 5]) for _ in range(n)] for f, n in enumerate([0, 1, 2, 57, 300])}
    rows = []
    for f, ids in files.items():
        for k in range(0, len(ids), 7):
            rows.append((f, k // 7, np.array(ids[k : k + 7], dtype="<u2").tobytes(), None))
    got = separators.separator_scan(spark.createDataFrame(rows, separators.BLOCKS), 0).collect()
    want = []
    for f, ids in files.items():
        at = 0
        for k, x in enumerate(ids):
            if x == 0:
                want.append((f, at, k - at, True))
                at = k + 1
        if at < len(ids):
            want.append((f, at, len(ids) - at, False))
    assert sorted((g.file_id, g.start, g.n_tokens, g.closed) for g in got) == sorted(want)
    assert separators.separator_scan(spark.createDataFrame([], separators.BLOCKS), 0).collect() == []
