"""Operator 7: held-out accuracy on planted rubbish, the exact draw, edges."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from marquee.llm import importance as im
from tests.llm.data import SCHEMA

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=1500, seed=8):
    """Clean, shouted and insulting documents; every second one is labelled."""
    r = random.Random(seed)
    parts = ["the", "an", "ion", "er", "re", "in", "ous", "ly", "tha", "ed"]
    word = lambda: "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
    docs, labels, bad = [], [], set()
    for k in range(n):
        words = [word() for _ in range(r.randint(40, 300))]
        kind = r.random()
        if kind < 0.1:
            for _ in range(max(4, len(words) // 25)):
                words[r.randrange(len(words))] = r.choice(["grumblefink", "snotwazzle", "yuckbrain"])
            bad.add(k)
        elif kind < 0.2:
            words = [w.upper() + "!!" for w in words]
            bad.add(k)
        docs.append((k, " ".join(words)))
        if k % 2:
            labels.append((k, int(kind < 0.1 or kind >= 0.2), int(kind < 0.1)))
    return docs, labels, bad


def test_rejects_what_is_planted_and_keeps_the_rest(spark):
    docs, labels, bad = corpus()
    got = im.classified(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    unseen = [r for r in got if r.doc_id % 2 == 0]
    caught = np.mean([not r.kept for r in unseen if r.doc_id in bad])
    spared = np.mean([r.kept for r in unseen if r.doc_id not in bad])
    assert len(got) == len(docs) and caught >= 0.95 and spared >= 0.97, (caught, spared)


def test_keep_drawn_agrees_and_keeps_columns(spark):
    docs, labels, _ = corpus(300)
    df = spark.createDataFrame([(d, 5, t, "c") for d, t in docs], "doc_id long, score int, text string, _draw0 string")
    marks = spark.createDataFrame(labels, LABELS)
    kept = {r.doc_id for r in im.classified(df, marks).collect() if r.kept}
    left = im.keep_drawn(df, marks)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == kept


def test_weights_equal_a_plain_sum():
    s = im.Settings(buckets=256)
    model = im.Model(s, np.linspace(-3, 1, 256).astype(np.float32))
    texts = ["", "abc", "abcde", "a longer text, with é and more", "x" * 3000]
    score, plain = model.weights(pa.array(texts))
    for k, t in enumerate(texts):
        b = np.frombuffer(t.encode(), np.uint8)
        v = model.ratios[im.buckets_of(b, s.gram, s.buckets)].astype(float)
        assert np.isclose(plain[k], v.sum())
        assert np.isclose(score[k], v[v < s.against].sum() / max(1, np.sqrt(len(v))))


def test_kth_largest(spark):
    r = random.Random(3)
    values = [r.gauss(0, 5) for _ in range(3000)] + [1.25] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 700, 3500):
        assert im.kth_largest(df, "v", k, bins=8, few=5) == ranked[k - 1]
    assert im.kth_largest(df, "v", 0) == np.inf
    assert im.kth_largest(df.where("v > 1e9"), "v", 3) == np.inf


def test_best_cut():
    score, good = np.array([0.1, 0.2, 0.3, 0.8, 0.9]), np.array([False, True, False, True, True])
    cut = im.best_cut(score, good)
    assert 0.1 < cut <= 0.8 and np.sum((score >= cut) != good) == 1
    assert im.best_cut(score, np.ones(5, bool)) == -np.inf
    assert im.best_cut(np.zeros(0), np.zeros(0, bool)) == -np.inf


def test_edges(spark):
    docs, labels, _ = corpus(200)
    marks = spark.createDataFrame(labels, LABELS)
    assert im.classified(spark.createDataFrame([], SCHEMA), marks).collect() == []
    none = spark.createDataFrame([(None, 1, 0), (1, None, 0)], LABELS)
    assert all(r.kept for r in im.classified(spark.createDataFrame(docs, SCHEMA), none).collect())
    odd = spark.createDataFrame([*docs, (None, "plain text"), (3000, None), (3001, ""), (7, docs[7][1])], SCHEMA)
    got = im.classified(odd, marks).collect()
    assert len(got) == 204 and {r.score for r in got if r.doc_id in (3000, 3001)} == {0.0}
    assert len({r.kept for r in got if r.doc_id == 7}) == 1
