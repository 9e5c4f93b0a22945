"""Operator 9 against brute force; prefix lemma, groups of copies, edges."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import jaccard
from marquee.llm.components import components
from tests.llm import brute
from tests.llm.data import SCHEMA, awkward, real


def check(spark, docs):
    got = jaccard.jaccard_components(spark.createDataFrame(docs, SCHEMA)).collect()
    want = brute.jaccard_groups(docs)
    assert len(got) == len(docs)
    wrong = [(r.doc_id, r.n_shingles, r.component_id, want[r.doc_id]) for r in got if (r.n_shingles, r.component_id) != want[r.doc_id]]
    assert not wrong, wrong[:5]
    return sum(r.component_id != r.doc_id for r in got)


def test_documents(spark):
    assert check(spark, real())


def test_awkward(spark):
    assert check(spark, awkward())


def test_chains_and_threshold(spark):
    """Documents around the threshold, and chains that only link neighbours."""
    r = random.Random(4)
    docs, k = [], 0
    for size in (5, 6, 9, 14, 24, 44, 104):
        base = [f"b{size}w{j}" for j in range(size)]
        for cut in range(0, size, max(1, size // 12)):
            docs.append((k, " ".join(base[: size - cut])))
            docs.append((k + 1, " ".join(base[:cut] + [f"n{k}"] + base[cut + 1 :])))
            k += 2
    chain = [f"c{j}" for j in range(400)]
    docs += [(k + j, " ".join(chain[j * 5 : j * 5 + 100])) for j in range(60)]
    r.shuffle(docs)
    assert check(spark, docs)


def test_large_group_of_near_copies(spark):
    r = random.Random(6)
    base = [f"w{j}" for j in range(120)]
    docs = []
    for k in range(250):
        words = list(base)
        for _ in range(r.randrange(1, 4)):
            words[r.randrange(120)] = f"own{k}"
        docs.append((k, " ".join(words)))
    assert check(spark, docs) > 150


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(0, 15), st.integers(0, 15), st.randoms())
def test_linked_sets_share_their_prefixes(common, left, right, r):
    """Any order, any choice of l: linked sets meet min(l, l') times."""
    a = {*range(common), *range(100, 100 + left)}
    b = {*range(common), *range(200, 200 + right)}
    if not jaccard.linked(common, len(a), len(b)):
        return
    order = list(a | b)
    r.shuffle(order)
    df = {x: r.randrange(1, 5) for x in order}
    prefixes = []
    for s in (a, b):
        s = sorted(s, key=lambda x: (df[x], order.index(x)))
        ell, length = jaccard.choose_prefix(np.array([df[x] for x in s], float), len(s))
        prefixes.append((ell, set(s[:length])))
    (k, p), (m, q) = prefixes
    assert len(p & q) >= min(k, m)


def test_prefix_grows_with_its_candidates():
    rare, common = np.ones(100), np.full(100, 50.0)
    assert jaccard.choose_prefix(rare, 100) == (1, 21)
    assert jaccard.choose_prefix(common, 100)[0] > 1


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[x] == find(x) for x in got)
    assert set(got) == {x for e in edges for x in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_edges(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(None, "a b", 1), (7, "A  b", 1), (7, "a\tB", 1), (8, None, 1), (9, "", 1), (None, "c", 1)], SCHEMA + ", rid int")
    got = jaccard.jaccard_components(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 1, 0), (0, 1, 7), (7, 1, 7), (7, 1, 7), (8, 0, 8), (9, 0, 9)]
    left = jaccard.one_per_component(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 7, 7, 8, 9]


def test_sets_need_little_more_than_the_texts(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5000)]
    texts = pa.chunked_array([["", "a", " ", *(" ".join(rng.choices(words, k=1200)) for _ in range(1500))]])
    size = sum(len(t.as_py()) for t in texts)
    jaccard.shingle_sets(texts.slice(0, 4))  # its tables stay
    tracemalloc.start()
    sets = jaccard.shingle_sets(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > 12_000_000 and peak < 5 * size
    assert [len(s) for s in sets[:3]] == [0, 1, 0]
    monkeypatch.setattr(jaccard, "runs", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    assert [s.tolist() for s in sets] == [s.tolist() for s in jaccard.shingle_sets(texts)]
