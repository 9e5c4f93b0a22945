"""The pipeline's stages, each against the plain version of its operator."""

from __future__ import annotations

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from marquee.llm import bpe  # noqa: E402
from tests.llm import brute  # noqa: E402
from tests.llm.data import SF, awkward, items  # noqa: E402
from tests.llm.test_line_chunks import brute as line_brute  # noqa: E402
from tests.llm.test_tokens import check_pieces  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], COLUMNS)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_duplicates", "decontaminate", "pack"]


def test_line_dedup(spark):
    rows = awkward()
    got = stage("line_dedup")(spark, docs_frame(spark, rows), SF)
    assert got.schema.simpleString() == docs_frame(spark, []).schema.simpleString()
    want = {d: t for d, (t, _, n) in line_brute(rows).items() if not n or t.strip(" \t\n\x0b\f\r")}
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text)


def test_near_duplicates(spark):
    rows = awkward()
    got = stage("near_duplicates")(spark, docs_frame(spark, rows), SF)
    want = {c for _, c in brute.jaccard_groups(rows).values()}
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)
    assert got.columns == docs_frame(spark, []).columns


def test_decontaminate(spark):
    rows = awkward() + [(900, "before " + items()[3][1] + " after")]
    got = stage("decontaminate")(spark, docs_frame(spark, rows), SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, _ in rows if d != 900)


def test_whole_run(spark):
    """Packed pieces of the last stage are those of the documents that the
    stages before it keep, run one after the other."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(f(spark, rows, SF).collect(), COLUMNS)
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert 50 < len(texts) < 200
    check_pieces(corpus_pipeline.run(spark, SF).collect(), texts, bpe.encoder(bpe.tokenizer_path()), 1024)


def test_empty_table(spark):
    rows = docs_frame(spark, [])
    for _, f in corpus_pipeline.STAGES:
        rows = f(spark, rows, SF)
        assert rows.collect() == []
        rows = docs_frame(spark, [])
