"""Operator 8 against brute force; hot passages and edges."""

from __future__ import annotations

import random

import pytest

from marquee.llm import blobs, exchange, phrases
from tests.llm import brute
from tests.llm.data import SCHEMA, awkward, real


def check(spark, docs):
    got = phrases.remove_repeated_phrases(spark.createDataFrame(docs, SCHEMA)).collect()
    want = brute.removed_phrases(docs)
    assert len(got) == len(docs)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want
    return sum(r.n_removed for r in got)


def test_awkward(spark):
    assert check(spark, awkward())


def test_documents(spark):
    assert check(spark, real())


def test_hot_passage_is_claimed_once_a_block(spark):
    hot = " ".join(f"h{k}" for k in range(40))
    docs = [(k, f"{hot} own{k} " + " ".join(f"w{k}x{j}" for j in range(14))) for k in range(300)]
    assert check(spark, docs) == 299 * 40


def test_equal_hashes_of_unequal_words_remove_nothing(spark):
    table = phrases.exchange.routed(iter([(0, 1, phrases.blobs.pack(
        *phrases._texts([(3, b" ".join(b"p%d" % k for k in range(13)))]),
        *phrases._texts([(3, b" ".join(b"q%d" % k for k in range(13)))]),
        *[phrases.np.array([0], "<u4")] * 3,
    ))]))
    assert phrases._confirm(table, 13).num_rows == 0


def owners_apart(size):
    """Spans of three owners' claims, some also in a passage of another owner."""
    words = lambda a, b: b" ".join(b"w%d" % k for k in range(a, b))
    own = [(1, words(0, 30)), (2, words(20, 60)), (2, words(70, 90)), (9, words(200, 220))]
    told = [(1, words(5, 25)), (2, words(15, 50) + b" x " + words(70, 85)), (9, words(195, 220)), (7, words(0, 30))]
    places = phrases.np.array([0, 1, 2, 3, 1], "<u4"), phrases.np.array([0, 1, 2, 3, 8], "<u4"), phrases.np.array([4, 0, 0, 0, 100], "<u4")
    row = blobs.pack(*phrases._texts(own), *phrases._texts(told), *places)
    got = phrases._confirm(exchange.routed(iter([(0, 5, row)])), size)
    return sorted(zip(*(x.tolist() for x in blobs.unpack(got.column("data")[0].as_py())), strict=True))


@pytest.mark.parametrize("held", [1, 1 << 30])
def test_every_owner_meets_its_claims(monkeypatch, held):
    monkeypatch.setattr(phrases, "AUTOMATON", held)
    want = [(0, 4, 20), (1, 5, 30), (1, 36, 15), (2, 5, 20), (8, 105, 30), (8, 136, 15)]
    assert owners_apart(13) == want


@pytest.mark.parametrize("characters", [1 << 20, 3])
def test_automaton_finds_every_occurrence(characters):
    """Also where the words are too many for a character each."""
    words = [b"%d" % (k * k % 7) for k in range(60)]
    a = phrases.Automaton(4, characters)
    a.add(words[:20], 9)
    a.add(words[10:30], 5)
    a.compile()
    patterns = {}
    for part, owner in ((words[:20], 9), (words[10:30], 5)):
        for i in range(len(part) - 3):
            key = tuple(part[i : i + 4])
            patterns[key] = min(owner, patterns.get(key, owner))
    want = [(i, patterns[tuple(words[i : i + 4])]) for i in range(57) if tuple(words[i : i + 4]) in patterns]
    assert a.width == (1 if characters > 3 else 2)
    assert list(zip(*(x.tolist() for x in a.find(words)), strict=True)) == want


def test_numbers_beyond_the_surrogates():
    words = [b"%d" % k for k in range(0xD7F0, 0xD820)]
    a = phrases.Automaton(3)
    a.numbers = {b"%d" % k: k + 1 for k in range(0xD900)}
    a.add(words, 4)
    a.compile()
    start, owner = a.find([b"x", *words, b"y"])
    assert start.tolist() == list(range(1, len(words) - 1)) and set(owner.tolist()) == {4}


@pytest.mark.parametrize("size", [2, 13])
def test_edges(spark, size):
    assert phrases.remove_repeated_phrases(spark.createDataFrame([], SCHEMA), size).collect() == []
    text = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(2, text, 1), (2, text, 1), (None, text, 1), (3, None, 1)], SCHEMA + ", shard int")
    got = phrases.remove_repeated_phrases(docs, size).collect()
    # a null doc_id comes before all others; equal ids never remove from each other
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 20, 0), (2, 20, 20), (2, 20, 20), (3, 0, 0)]
    assert exchange.ROUTED.startswith("shard")


def test_near_copies_spread(spark, monkeypatch):
    """The claims of many near copies on one owner go to many shards, and all
    are confirmed."""
    r = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    docs = [(1, " ".join(base))]
    for k in range(1500):
        near = list(base)
        for _ in range(3):
            near[r.randrange(len(near))] = f"e{r.randrange(10**6)}"
        docs.append((100 + k, " ".join(near)))
    made, finish = [], exchange.finish
    monkeypatch.setattr(exchange, "finish", lambda *a: made.append(finish(*a)) or made[-1])
    check(spark, docs)
    sent: dict[int, int] = {}
    for row in made[0].collect():
        sent[row.shard] = sent.get(row.shard, 0) + int(blobs.unpack(row.data)[4].sum())
    assert sum(sent.values()) > 500_000 and max(sent.values()) < 0.5 * sum(sent.values())
