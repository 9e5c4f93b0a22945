"""The registered ``opN_<name>`` queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    alignment,
    bpe,
    centroids,
    importance,
    jaccard,
    line_chunks,
    mixing,
    ngram_trie,
    oracle,
    packing,
    phrases,
    rules,
    separators,
    token_files,
    winnowing,
)
from marquee.llm.common import table


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the bigram trie of the training documents."""
    return ngram_trie.fit_and_score(table(spark, sf_dir, "documents"))[1]


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents under the current policy."""
    rows = rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bit-packed token files of all documents, read back."""
    rows = token_files.packed_token_files(table(spark, sf_dir, "documents"), bpe.tokenizer_path(), end_id=2)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the line chunks that an earlier one holds."""
    rows = line_chunks.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents concatenated and cut into sequences of 1024 ids."""
    return packing.concatenate_and_cut(table(spark, sf_dir, "documents"), bpe.tokenizer_path(), end_id=0, window=1024)


def op6_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from flat token files without an index."""
    end_id = 50256
    blocks = separators.flat_files(table(spark, sf_dir, "documents"), bpe.tokenizer_path(), end_id)
    return separators.separator_scan(blocks, end_id).select(
        "doc_id", "file_id", "start", "n_tokens", F.col("closed")
    )


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by importance; kept: drawn by Gumbel top-k."""
    return importance.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the phrases that a smaller doc_id holds."""
    rows = phrases.remove_repeated_phrases(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    return winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a mix of their sources at 150 % of all words."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole vectors in 16 clusters after three rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3).drop("n_scans")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two tokenizations, aligned, with corpus-wide pair counts."""
    docs = table(spark, sf_dir, "documents")
    return alignment.aligned(docs, bpe.tokenizer_path(), bpe.tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_trie,
        op2_rule_ledger,
        op3_token_files,
        op4_line_chunks,
        op5_packing,
        op6_separator_scan,
        op7_importance,
        op8_phrases,
        op9_jaccard,
        op10_winnowing,
        op11_mixing,
        op12_centroids,
        op13_alignment,
    )
}

ORACLE_SQL: dict[str, str] = oracle.SQL
