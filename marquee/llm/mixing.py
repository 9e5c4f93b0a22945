"""Mixing sources to target weights (operator 11).

Every document gets a hash-random key; documents are range-sorted by key within
their source, distributed prefix sums give the words before each, and each
source is cut at its exact budget. A budget above the source's size is whole
epochs first (every document once an epoch), then a cut of one more.

Targets: the sources in code point order, null last, get the weights in turn,
and divide ``share`` of all words in proportion; a target above ``most`` times
its source stops there, and what it leaves is divided again by weight among the
others until none is above. Only scalars of that fixpoint reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import prefix
from marquee.llm.common import written
from marquee.llm.textnp import SPACES, buffer

SIZED = "doc_id long, grp string, key string, size long"
_SLICE = 1 << 24


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words (runs of other bytes than space and \\t to \\r) of each text; null has none."""
    data, offsets = buffer(texts.fill_null(""))
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    for at in range(0, len(data), _SLICE):  # a slice at a time bounds the memory
        stop = min(at + _SLICE, len(data))
        inside = ~SPACES[data[at:stop]]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        if at and not SPACES[data[at - 1]]:
            begins[0] = False
        edges = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at
        begins[edges] = inside[edges]  # a text's start begins a word
        where = np.searchsorted(offsets, np.flatnonzero(begins) + at, side="right") - 1
        counts += np.bincount(where, minlength=len(counts))
    return counts


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pa.array(word_counts(batch.column(3)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], size], names=["doc_id", "grp", "key", "size"])


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """(doc_id, grp, key, size) of every document, as a table: ``grp`` is the
    source behind a 0, or 1 for null (which so comes last), ``key`` is the md5 of
    seed, doc_id and text."""
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    named = F.coalesce(F.concat(F.lit("0"), docs["source"].cast("string")), F.lit("1"))
    code = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    rows = docs.select(doc_id.alias("doc_id"), named.alias("grp"), F.md5(code).alias("key"), text.alias("text"))
    return written(rows.mapInArrow(_sized, SIZED), "mixing-sizes")


def budgets(rows: DataFrame, weights: tuple[int, ...], share: Fraction, most: int) -> DataFrame:
    """(grp, source_size, target, budget) of every source."""
    sizes = rows.groupBy("grp").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    numbered, offsets = prefix.ranged(sizes.withColumn("all", F.lit("")), "all", ("grp",), "one", "mixing-sources")
    place = numbered.join(offsets, ["part", "all"]).withColumn("place", F.col("in_part") + F.col("offset"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    found = place.select("grp", "source_size", cap.alias("cap"), weight.cast("long").alias("weight"))
    found = written(found, "mixing-weights")

    def exact(n: int):  # an integer of any size as a column
        return F.lit(str(n)).cast("decimal(38,0)")

    def above(p: int, q: int):  # the share p / q a unit of weight is more than the source may give
        return F.col("cap").cast("decimal(20,0)") * exact(q).cast("decimal(18,0)") < exact(p).cast("decimal(28,0)") * F.col("weight").cast("decimal(10,0)")

    p, q, stopped = 0, 1, -1
    while True:  # each turn stops more sources, so it ends; one row comes back
        over = above(p, q)
        facts = found.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"),
            F.count(F.when(over, 1)).alias("stopped"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if facts["stopped"] == stopped or not facts["weight"]:
            break
        stopped = facts["stopped"]
        p = share.numerator * facts["size"] - share.denominator * facts["held"]
        q = share.denominator * facts["weight"]
    target = F.when(above(p, q), F.col("cap").cast("double")).otherwise(F.lit(float(p)) * F.col("weight") / F.lit(float(q)))
    found = found.withColumn("target", target)
    return found.select("grp", "source_size", "target", F.floor(F.col("target") + 0.5).cast("long").alias("budget"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target
    (words its source should give), taken (words the mix takes of it, repeats
    counted).

    The taken words of a source add up to its target, rounded: every document
    counts ``floor(target / source_size)`` times, and one document of the source
    is cut between words. No document gives more than ``most`` times its size.

    Null text has no words. Null is a source of its own, after all others; null
    and repeated doc_ids are documents like any other. The order within a source
    is by md5 of (seed, doc_id, text): the same for every run and layout; rows
    equal in all three and in source change places freely, which changes no
    result row. Sources without words have target 0; an empty table gives no
    rows. Columns besides doc_id, text and source are left behind.
    """
    rows = sized(docs, seed)
    wanted = written(budgets(rows, weights, share, most), "mixing-budgets")
    placed, offsets = prefix.ranged(rows, "grp", ("key",), "size", "mixing-order")
    at = offsets.join(wanted, "grp")  # a row per (range, source)
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - whole * F.col("source_size") - F.col("offset") - F.col("in_part")
    taken = whole * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return placed.join(at, ["part", "grp"]).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.when(F.col("grp") != "1", F.expr("substr(grp, 2)")).alias("source"),
    )
