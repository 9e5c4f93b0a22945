"""A training-corpus pipeline over ``documents``: filter, deduplicate, decontaminate, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. Between stages the rows are written as Parquet in the
shared folder and read again, so a stage never depends on the executors that
ran the one before it. All stages but the last keep the columns of the
documents; the last returns boundary records of packed sequences.

Rows: a null text counts as empty and is never toxic, repeated or
contaminated; a null doc_id survives unless its own text is rejected; extra
columns travel along; an empty table gives no rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, importance, jaccard, line_chunks, packing, winnowing
from marquee.llm.common import WHITESPACE, table, written

SEQUENCE = 1024
END_ID = 0


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws (operator 7)."""
    return importance.keep_drawn(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks an earlier one holds (operator
    4); ``n_chars`` follows the text, and a document that loses all its text goes."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = line_chunks.remove_repeated_chunks(docs.select("doc_id", "text", *others), others)
    changed = cut["n_removed"] > 0
    cut = cut.where(~changed | (F.length(F.btrim("text", F.lit(WHITESPACE))) > 0))
    out = {c: F.col(c) for c in docs.columns}
    if "n_chars" in out:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return cut.select(*[c.cast(docs.schema[name].dataType).alias(name) for name, c in out.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every near-duplicate component (operator 9)."""
    return jaccard.one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window (operator 10)."""
    return winnowing.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the survivors, concatenated and cut (operator 5)."""
    return packing.concatenate_and_cut(docs, bpe.tokenizer_path(), END_ID, SEQUENCE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL expresses neither the fitted classifier nor the tokenizer; the stages
#: are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` to packed pieces."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
