"""Operator 10: exact windows against brute force, and the winnowing guarantee."""

from __future__ import annotations

import random

import pytest

from marquee.llm import queries
from marquee.llm import winnowing as w
from tests.llm import brute
from tests.llm.data import SCHEMA, awkward, items, real
from tests.oracle_check import compare

ITEMS = "item_id long, text string"


def check(spark, docs, bench):
    got = w.decontaminate(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(bench, ITEMS)).collect()
    want = brute.contamination(docs, bench)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id], r.doc_id


def test_documents(spark):
    check(spark, real(), items())


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, 0])
def test_planted_windows_of_every_length(spark, monkeypatch, broadcast_bytes):
    """Items of 0 to 30 words, planted whole, in part and with a word changed;
    also through the shuffle joins."""
    monkeypatch.setattr(w, "BROADCAST_BYTES", broadcast_bytes)
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdef") for _ in range(3))
    bench = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([0, 1, 2, 4, 5, 7, 9, 10, 11, 15, 30])]
    bench += [(90, bench[-1][1]), (91, None), (92, "Same, item! " + bench[7][1])]
    docs = list(awkward())
    for k, (_, text) in enumerate(bench):
        parts = (text or "").split()
        for j, some in enumerate([parts, parts[1:], parts[: len(parts) // 2], [*parts[:5], "zzz", *parts[6:]]]):
            fill = [word() + "q" for _ in range(25)]
            at = r.randrange(len(fill))
            docs.append((5000 + 10 * k + j, ", ".join(fill[:at]) + "-" + " ".join(some).upper() + "-" + " ".join(fill[at:])))
    check(spark, docs, bench)


def test_any_shared_window_shares_a_fingerprint(spark):
    """The guarantee, on random word runs that overlap in exactly WINDOW words."""
    r = random.Random(2)
    shared = [[str(r.randrange(50)) for _ in range(w.WINDOW)] for _ in range(60)]
    rows = []
    for k, s in enumerate(shared):
        for side in (0, 1):
            left, right = ([f"{side}x{r.randrange(99)}" for _ in range(r.randrange(12))] for _ in range(2))
            rows.append((2 * k + side, " ".join(left + s + right)))
    marked = w._windows(w._words(spark.createDataFrame(rows, SCHEMA)), [])
    marks = {x.doc_id: set(x.marks[0].mark) for x in marked.select("doc_id", "marks").collect()}
    assert all(marks[2 * k] & marks[2 * k + 1] for k in range(len(shared)))


def test_edges(spark):
    bench = spark.createDataFrame(items(), ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert w.decontaminate(spark.createDataFrame([], SCHEMA), bench).collect() == []
    text = items()[0][1]
    docs = spark.createDataFrame([(None, text, 1), (5, text, 2), (5, text, 3), (6, None, 4)], SCHEMA + ", k long")
    got = sorted(((r.doc_id or 0), r.contaminated, r.n_items) for r in w.decontaminate(docs, bench).collect())
    assert got == [(0, True, 1), (5, True, 1), (5, True, 1), (6, False, 0)]
    assert not any(r.contaminated for r in w.decontaminate(docs, none).collect())
    left = w.clean_documents(docs, bench)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [6]


def test_each_row_is_judged_by_its_own_text(spark):
    """A contaminated row takes no clean row with it, without doc_id or with the same one."""
    leak, clean = items()[0][1], "nothing of any benchmark"
    rows = [(None, leak, 1), (None, clean, 2), (None, None, 3), (5, leak, 4), (5, clean, 5), (5, clean, 6), (6, leak.upper(), 7), (7, clean, 8)]
    left = w.clean_documents(spark.createDataFrame(rows, SCHEMA + ", k long"), spark.createDataFrame(items(), ITEMS))
    assert sorted((r.k, r.doc_id, r.text) for r in left.collect()) == sorted((k, d, t) for d, t, k in rows if k in (2, 3, 5, 6, 8))


def test_without_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        check(spark, real(60), items())
        check(spark, awkward(), [])
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_query_equals_sql(spark):
    got = compare(spark, "op10_winnowing", queries.op10_winnowing, queries.ORACLE_SQL["op10_winnowing"], "/root/testdata/sf0.01")
    assert "error" not in got and got["spark_rows"] == 1000


def test_native(spark):
    plan = w.decontaminate(spark.createDataFrame(real(5), SCHEMA), spark.createDataFrame(items(), ITEMS))
    text = plan._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Pandas", "ArrowEval", "MapInArrow"))
