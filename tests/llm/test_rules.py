"""Operator 2: measurements against brute force, policies and ablation by masks."""

from __future__ import annotations

from marquee.llm import rules
from tests.llm import brute
from tests.llm.data import SCHEMA, awkward, real


def test_measurements(spark):
    docs = awkward() + [(1000 + d, t) for d, t in real()]
    got = rules.apply_policy(rules.ledger(spark.createDataFrame(docs, SCHEMA))).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        want = brute.measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


def test_every_rule_can_fail_and_clean_text_passes(spark):
    plain = "the quick brown fox jumps over a lazy dog beside nine old river stones"
    docs = [
        (0, plain),
        (1, "too short"),
        (2, plain + " " + "say it again and again " * 20),
        (3, plain.replace(" ", " # ")),
        (4, (plain[:30] + "\n") * 4 + "\n".join(f"{k} other words here" for k in range(2))),
        (5, plain.upper()),
        (6, " ".join("a" for _ in range(3)) + " b c d e f g h i j k l m"),
    ]
    rows = {r.doc_id: r.failed for r in rules.ledger(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert rows[0] == 0
    for k, name in enumerate(r.name for r in rules.RULES):
        assert rows[k + 1] & rules.mask((name,)), name


def test_policies_are_masks_and_ablation_adds_up(spark):
    docs = real()
    ledger = rules.ledger(spark.createDataFrame(docs, SCHEMA)).cache()
    failed = [r.failed for r in ledger.collect()]
    for version, names in rules.POLICIES.items():
        mask = rules.mask(names)
        kept = rules.apply_policy(ledger, version).where("kept").count()
        assert kept == sum(f & mask == 0 for f in failed)
        got = {r.rule: (r.n_failed, r.n_only, r.n_dropped) for r in rules.ablation(ledger, version).collect()}
        for name in names:
            bit = rules.mask((name,))
            want = sum(f & bit > 0 for f in failed), sum(f & mask == bit for f in failed), sum(f & mask > 0 for f in failed)
            assert got[name] == want
    ledger.unpersist()


def test_edges(spark):
    assert rules.ledger(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(None, None, "q"), (1, "a", "q"), (1, "a", "q")], SCHEMA + ", words string")
    assert sorted((r.doc_id or 0, r.n_words) for r in rules.ledger(rows).collect()) == [(0, 0), (1, 1), (1, 1)]


def test_native(spark):
    plan = rules.apply_policy(rules.ledger(spark.createDataFrame([(1, "a")], SCHEMA)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Exchange"))
