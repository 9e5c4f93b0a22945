"""Rule bitmask ledger (operator 2), in DataFrame functions only.

``ledger`` evaluates every rule once per document: one row of measurements and
one ``failed`` mask with a bit per rule. Policies are versioned sets of rules,
so applying one, comparing two, or asking what a rule costs is arithmetic on
masks; no text is read again. ``ablation`` first counts documents per distinct
mask (at most 2**rules rows, combined before the shuffle) and works on those.

All work on a document stays inside its row, so the ledger needs no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WHITESPACE

# The characters counted as symbols, and the white-space class.
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Fails a document when ``fails`` (over the measurements) is true."""

    name: str
    fails: str


# The bit of a rule is its place here; new rules are appended, never moved.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("shouting", "100 * n_capitals > 30 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
)
BASE = ("too_few_words", "repeated_words")
# Every version keeps the rules it began with; a change is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": (*BASE, "symbols", "repeated_lines", "shouting", "word_length"),
}
CURRENT = "v2"


def mask(names: tuple[str, ...]) -> int:
    bits = {r.name: 1 << k for k, r in enumerate(RULES)}
    return sum(bits[n] for n in names)


def _removed(text: Column, characters: str) -> Column:
    """How many of ``characters`` the text holds."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _tuple(array: str, i: Column, size: int) -> list[Column]:
    return [F.get(array, i + j) for j in range(size)]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each whole text (null text: no words).

    Repeated windows are first looked for among 64-bit hashes; a document with
    two equal hashes is decided on the windows' words themselves.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.length(F.translate("text", WHITESPACE, "")).cast("long").alias("word_chars"),
        _removed(F.col("text"), SYMBOLS).alias("n_symbols"),
        _removed(F.col("text"), CAPITALS).alias("n_capitals"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, WHITESPACE, "")) > 0).alias("lines"),
    )
    rows = rows.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    n = F.size("words") - (WINDOW - 1)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("places", places)
    rows = rows.withColumn("windows", F.transform("places", lambda i: F.xxhash64(*_tuple("hashes", i, WINDOW))))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    exact = F.array_sort(
        F.transform("places", lambda i: F.struct(F.concat_ws(" ", *_tuple("words", i, WINDOW)).alias("w"), i.alias("i")))
    )
    rows = rows.withColumn("sorted", F.when(twice, exact))
    rows = rows.withColumn(
        "starts",
        F.array_sort(
            F.transform(
                F.filter(
                    "sorted",
                    lambda s, k: F.coalesce(s["w"] == F.get("sorted", k - 1)["w"], F.lit(False))
                    | F.coalesce(s["w"] == F.get("sorted", k + 1)["w"], F.lit(False)),
                ),
                lambda s: s["i"],
            )
        ),
    )
    covered = F.transform(
        "starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - s, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(total, F.lit(0).cast("long")).alias("n_repeat_words"), "n_lines", "n_capitals",
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: measurements and ``failed``, a bit for each rule.

    Null and empty texts have no words and fail ``too_few_words``; repeated
    rows and null doc_ids each keep their own ledger row; an empty table gives
    an empty ledger; columns besides doc_id and text are ignored.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, r in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured(docs).withColumn("failed", failed)


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and the policy's ``kept``."""
    failed = F.col("failed")
    return rows.select(
        "*",
        (failed.bitwiseAND(F.lit(mask(BASE))) != 0).alias("base_failed"),
        (failed.bitwiseAND(F.lit(mask(POLICIES[version]))) == 0).alias("kept"),
    )


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: rule, n_failed, n_only (documents that only this
    rule drops: what dropping the rule would bring back), n_dropped (all)."""
    names = POLICIES[version]
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(names))).alias("m")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(x).alias("rule"), F.lit(mask((x,))).cast("long").alias("bit")) for x in names])
    each = masks.select("m", "n", F.explode(rules).alias("r"))
    hit = F.col("m").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy("r.rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("m") != 0, F.col("n")).otherwise(0)).alias("n_dropped"),
    )
