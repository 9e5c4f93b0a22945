"""Benchmark decontamination by winnowing (operator 10), in DataFrame functions only.

Both sides hash every run of ``k`` words and keep the smallest hash of every
``WINDOW - k + 1`` consecutive ones, so any shared run of ``WINDOW`` words has a
kept hash in common: the guarantee of winnowing. Fingerprints of documents and
benchmark are joined (pass 1); documents that share one are read again and the
hits extended to whole windows, compared word by word (pass 2). Items shorter
than a window take part as one window of their own length, whose single hash
is looked up among all the documents' runs of that length.

Arrays are exploded with the outer form and nulls dropped after it: an inner
explode would push a filter on the array's size below the projections that
build it, and have it built several times.

The benchmark side is broadcast only if its counted bytes allow; beyond that
both joins shuffle. Nothing of the documents is broadcast but a bitmap of fixed
size. A fingerprint is sent once per document, so repeated
phrases cost what they would once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.operators import key_filter, may_hold

# ASCII other than letters and digits parts words; capitals fold.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
GRAM = 5
BROADCAST_BYTES = 32 << 20  # of the benchmark's windows; more are joined by shuffle
FILTER_BITS = 1 << 20
_NO_ID = -(1 << 63)


def _lowered(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)


def _words(rows: DataFrame) -> DataFrame:
    """Adds ``words`` and their ``hashes``."""
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _grams(k: int) -> Column:
    """Hashes of all runs of k words, from the words' hashes."""
    n = F.size("hashes") - (k - 1)
    runs = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(k)], F.lit(k))
    )
    return F.when(n > 0, runs).otherwise(F.array().cast("array<bigint>"))


def _minima(grams: str, span: int) -> Column:
    """The smallest of each ``span`` consecutive grams: place i belongs to the
    window that begins at word i."""
    n = F.size(grams) - (span - 1)
    low = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.least(*[F.get(grams, i + j) for j in range(span)]))
    return F.when(n > 0, low).otherwise(F.array().cast("array<bigint>"))


def _windows(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``marks``: for each window length an array with, at every place, the
    fingerprint of the window that begins there."""
    rows = rows.withColumn("grams", _grams(GRAM))
    full = F.struct(F.lit(WINDOW).alias("size"), _minima("grams", WINDOW - GRAM + 1).alias("mark"))
    short = [F.struct(F.lit(k).alias("size"), _grams(k).alias("mark")) for k in lengths]
    return rows.withColumn("marks", F.array(full, *short))


def _within(items: DataFrame) -> bool:
    """Whether the benchmark's windows, as counted bytes, may be broadcast."""
    size = F.length("window") * 4 + F.coalesce(F.length("item_id"), F.lit(0)) * 4 + 64
    return (items.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0) <= BROADCAST_BYTES


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """(item_id, size, mark, window) of every window of every item, and the
    lengths below WINDOW that occur (at most WINDOW - 1 numbers)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), _lowered("text").alias("text"))
    items = _words(items).where(F.size("words") > 0)
    short = items.where(F.size("words") < WINDOW).select(F.size("words").alias("n")).distinct()
    lengths = sorted(r["n"] for r in short.collect())
    whole = _windows(items, lengths).select("item_id", "words", F.explode_outer("marks").alias("m"))
    fits = (F.col("m.size") == WINDOW) | (F.col("m.size") == F.size("words"))
    windows = whole.where(fits).select("item_id", "words", "m.size", F.posexplode_outer("m.mark").alias("i", "mark"))
    windows = windows.where("mark is not null")
    text = F.concat_ws(" ", F.slice("words", F.col("i") + 1, F.col("size")))
    return written(windows.select("item_id", "size", "mark", text.alias("window")).distinct(), "items"), lengths


def _row_key() -> list[Column]:
    """``k`` and ``h`` of a document row: its doc_id and a hash of its text."""
    k = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("k")
    return [k, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h")]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*_row_key(), F.col("doc_id").cast("long").alias("doc_id"), _lowered("text").alias("text"))


def _hit_rows(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k, h, doc_id, n_words) of every document row, and (k, h, n_hit, items)
    of those that have a hit."""
    items, lengths = item_windows(benchmark)
    side = F.broadcast if _within(items) else lambda df: df
    keyed = _keyed(docs)

    # pass 1: the words are counted, and fingerprints shared with the benchmark found. One more
    # entry per row, spread by its key, carries the row through the join whatever it shares
    fingers = F.array_distinct(F.flatten(F.transform("marks", lambda m: m["mark"])))
    found = F.transform(fingers, lambda x: F.struct(x.alias("mark"), F.lit(False).alias("row")))
    entries = F.concat(F.array(F.struct(F.xxhash64("h", "k").alias("mark"), F.lit(True).alias("row"))), found)
    rows = _windows(_words(keyed), lengths)
    sent = rows.select("k", "h", "doc_id", F.size("words").cast("long").alias("n_words"), F.explode_outer(entries).alias("e"))
    marks = items.select("mark").distinct().withColumn("shared", F.lit(True))
    kept = sent.select("k", "h", "doc_id", "n_words", "e.mark", "e.row").join(side(marks), "mark", "left")
    pass1 = written(kept.where("row or shared"), "fingerprints")
    counted = pass1.where("row").select("k", "h", "doc_id", "n_words")
    candidates = pass1.where("not row").groupBy("k", "h").agg(F.collect_set("mark").alias("shared"))
    candidates = written(candidates, "candidates")

    # pass 2: the candidates' windows at those fingerprints, word by word; a bitmap of fixed
    # size leaves few other texts to be shuffled
    near = keyed.where(may_hold(key_filter(candidates.select("h"), "h", FILTER_BITS), F.col("h"), FILTER_BITS))
    again = near.join(candidates, ["k", "h"])
    again = _windows(_words(again), lengths).select("k", "h", "shared", "words", F.explode_outer("marks").alias("m"))
    at = F.filter(
        F.transform(
            "m.mark",
            lambda x, i: F.when(
                F.array_contains("shared", x),
                F.struct(i.alias("i"), x.alias("mark"), F.concat_ws(" ", F.slice("words", i + 1, F.col("m.size"))).alias("window")),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    found = again.select("k", "h", F.col("m.size").alias("size"), F.explode_outer(at).alias("w"))
    found = found.select("k", "h", "size", "w.i", "w.mark", "w.window").where("mark is not null")
    hits = found.join(side(items), ["mark", "size", "window"])
    by_doc = hits.groupBy("k", "h", "i", "size").agg(F.collect_set("item_id").alias("items"))
    ordered = Window.partitionBy("k", "h").orderBy("i", "size")
    seen = F.max(F.col("i") + F.col("size")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("i") + F.col("size")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("i"), F.coalesce(seen, F.lit(0))))
    covered = by_doc.select("k", "h", "items", new.cast("long").alias("new"))
    hit = covered.groupBy("k", "h").agg(
        F.sum("new").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return counted, hit


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit (words inside an
    occurrence of an item window), n_items, items_sha256 (of those item_ids,
    sorted as strings and joined by commas), contaminated.

    Null and empty texts have no words and no hits; null doc_ids are kept;
    rows with equal doc_id and text share their result; an empty benchmark
    leaves every document clean; other columns are ignored. Items with equal
    text count each; null item_ids are not counted as items, though their
    windows hit.
    """
    counted, per_doc = _hit_rows(docs, benchmark)
    joined = counted.join(per_doc, ["k", "h"], "left")
    names = F.coalesce(F.array_join("items", ","), F.lit(""))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, all their columns unchanged. Each row goes
    or stays by its own text, also where doc_ids are null or shared."""
    bad = _hit_rows(docs, benchmark)[1].select(F.col("k").alias("bad_k"), F.col("h").alias("bad_h"))
    k, h = _row_key()
    return docs.join(bad, (k == bad["bad_k"]) & (h == bad["bad_h"]), "left_anti")
