"""Operator 13 against whole-text tokenization and sets of byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marquee.llm import alignment, bpe, queries
from tests.llm.data import SCHEMA, awkward, real

A, B = bpe.tokenizer_path(), bpe.tokenizer_path("piece_bpe_32k.model")


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.back = {c: b for b, c in bpe.byte_alphabet().items()}

    def tokens(self, text):
        if not text:
            return [], []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(k, bytes(self.back[c] for c in self.a.id_to_token(k))) for k in a]
        b = [(k, self.b.id_to_piece(k)) for k in self.b.encode(text)]
        b = [(k, bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()) for k, p in b]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    @staticmethod
    def ranges(tokens):
        at, out = 0, []
        for k, raw in tokens:
            out.append((k, at, at + len(raw)))
            at += len(raw)
        return out

    def aligned(self, text):
        a, b = map(self.ranges, self.tokens(text))
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(k) for k, _, x in side if start < x <= e) for side in (a, b)))
            start = e
        owners = [[n for n, (_, s, e) in enumerate(side) for _ in range(s, e)] for side in (a, b)]  # the token of each byte
        links = [(a[i][0], b[j][0]) for i, j in sorted(set(zip(*owners, strict=True)))]
        return len(a), len(b), groups, links

    def query(self, rows):
        docs = [(d, *self.aligned(t)) for d, t in rows]
        held = Counter(p for *_, links in docs for p in set(links))
        best = defaultdict(int)
        for (i, _), n in held.items():
            best[i] = max(best[i], n)
        return [
            (d, na, nb, len(g), len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls),
             hashlib.sha256(";".join(g).encode()).hexdigest() if na else "")
            for d, na, nb, g, ls in docs
        ]


@pytest.fixture(scope="module")
def brute():
    return Brute()


def key(row):
    return tuple((x is None, x) for x in row)


def run(spark, rows, **more):
    return sorted((tuple(r) for r in alignment.aligned(spark.createDataFrame(rows, SCHEMA), A, B, **more).collect()), key=key)


ODD = [
    "a  b", " a", "a ", "  ", " ", "\n", "\na", "a\n \nb", "a \n b", "a\n b", "x   y\t z", "▁", "a ▁b", "<s> <unk> <0x41>",
    "<|endoftext|> a <|endoftext|>", "é漢 字", "\x00 \x1c a \x85 b\xa0c", "a　 b", "'s don't 'll", "I'm 12 345", "a\x1c b", "-- !! ?", "x" * 700,
]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abt'sZ9 \n\t\x85\xa0!.é漢\x1c▁　<>"), max_size=25))
def test_units_equal_whole_texts(text):
    al = alignment.aligner(A, B)
    want = whole_brute.aligned(text)
    units = al.take([text])[0]
    facts = al.facts[units]
    if not text or not facts[:, 3].all():
        assert want[:2] == (0, 0)
        return
    assert facts[:, :3].sum(axis=0).tolist() == [want[0], want[1], len(want[2])]
    assert b"".join(al.form[u] for u in units)[:-1].decode() == ";".join(want[2])
    links = np.concatenate([al.links[al.link_at[u] : al.link_at[u + 1]] for u in units])
    assert Counter((int(x) >> 32, int(x) & 0xFFFFFFFF) for x in links) == Counter(want[3])


whole_brute = Brute()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), unique=True, max_size=60), st.lists(st.integers(1, 300), unique=True, max_size=60), st.integers(0, 5))
def test_gallop_is_a_search(short, long, back):
    short, long = np.array(sorted(short), dtype=np.int64), np.array(sorted(long), dtype=np.int64)
    place = np.searchsorted(long, short)
    start = np.maximum(place - back, 0)
    assert alignment.gallop(short, long, start).tolist() == place.tolist()
    assert alignment.gallop(short, long, np.zeros(len(short), np.int64)).tolist() == place.tolist()


def test_whole_tables(spark, brute):
    rows = real(120) + [(1000 + k, t) for k, t in enumerate(ODD)]
    assert run(spark, rows, chunk_bytes=20_000) == sorted(brute.query(rows), key=key)


def test_edges(spark, brute):
    rows = [r for r in awkward() if r[0] not in (82, 83)]
    rows += rows[:3] + [(None, "no id at all"), (None, None), (7, "one"), (7, "two words"), (83, "y" * 3000)]
    assert run(spark, rows) == sorted(brute.query(rows), key=key)
    assert run(spark, []) == []


def test_very_long_texts(spark):
    rows = [r for r in awkward() if r[0] in (82, 83)]
    got = {r[0]: r for r in run(spark, rows, chunk_bytes=10)}
    for doc_id, text in rows:
        a, b = map(whole_brute.ranges, whole_brute.tokens(text))
        common = len({e for *_, e in a} & {e for *_, e in b})
        assert got[doc_id][1:5] == (len(a), len(b), common, len(a) + len(b) - common)


def test_chunks_and_forgotten_units_change_nothing(spark, monkeypatch):
    rows = real(60)
    want = run(spark, rows)
    assert run(spark, rows, chunk_bytes=1) == want
    al = alignment.Aligner(A, B)
    monkeypatch.setattr(alignment, "_UNITS_KEPT", 3)
    fresh = [[al.form[u] for u in al.take([t])[0]] for _, t in rows[:20]]
    whole = alignment.aligner(A, B)
    assert fresh == [[whole.form[u] for u in whole.take([t])[0]] for _, t in rows[:20]]


def test_clashing_columns_and_query(spark, brute, tmp_path):
    rows = real(30)
    docs = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], SCHEMA + ", chunk int, pairs string")
    got = sorted((tuple(r) for r in alignment.aligned(docs, A, B).collect()), key=key)
    assert got == sorted(brute.query(rows), key=key)
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in queries.op13_alignment(spark, str(tmp_path)).collect()), key=key) == got


def test_no_single_task_and_no_python_rows(spark):
    docs = spark.createDataFrame(real(20), SCHEMA)
    plan = alignment.pair_counts(alignment.chunked(docs, A, B))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert alignment.pair_counts(alignment.chunked(docs, A, B)).where(F.col("best")).count() > 0
