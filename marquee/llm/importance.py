"""Importance resampling as a quality classifier (operator 7).

Two generative models over hashed n-grams of bytes, one of the target text
(labelled good) and one of the raw text (all documents), give every n-gram a
log ratio. A document's importance is the sum of the ratios that speak clearly
against the target, over the square root of its number of n-grams, so neither
long documents nor the drift of common n-grams decide. Gumbel noise is added
and the k largest are drawn: sampling without replacement in proportion to the
importance. k is the number of documents above the score that best parts the
labelled rows kept aside.

The models are dense arrays of ``buckets`` numbers whatever the input, so they
may be broadcast. Labels are the one bounded sample (``max_labelled`` rows,
smallest id hashes first); counts, scores and the draw cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import begin, id_and_text, written
from marquee.llm.textnp import U64, buffer, mix, runs

_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Settings:
    gram: int = 5  # bytes in an n-gram
    buckets: int = 1 << 18
    pseudo: float = 1.0  # added to both models' counts
    against: float = -1.0  # ratios below this speak against the target
    temperature: float = 0.02  # scale of the Gumbel noise
    max_labelled: int = 200_000
    held_out: int = 4  # every n-th labelled id, by hash, sets k


def buckets_of(data: np.ndarray, gram: int, buckets: int) -> np.ndarray:
    """The bucket of the n-gram at every byte (len - gram + 1 of them)."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(gram):
        h *= U64(257)
        h += data[j : j + n]
    return (mix(h) & U64(buckets - 1)).astype(np.int64)


def _own(offsets: np.ndarray, a: int, b: int, gram: int) -> np.ndarray:
    """Which places of the run's n-grams lie within one text."""
    inside = np.ones(max(0, int(offsets[b] - offsets[a]) - gram + 1), dtype=bool)
    for edge in offsets[a + 1 : b] - offsets[a]:
        inside[max(0, edge - gram + 1) : edge] = False
    return inside


def _count(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Counts of a whole task: (bucket, raw, target), zero rows left out."""
    raw, target = np.zeros(s.buckets, dtype=np.int64), np.zeros(s.buckets, dtype=np.int64)
    begin()
    for batch in batches:
        data, offsets = buffer(batch.column(0))
        fit = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
        for a, b in runs(offsets):
            found = buckets_of(data[offsets[a] : offsets[b]], s.gram, s.buckets)
            inside = _own(offsets, a, b, s.gram)
            raw += np.bincount(found[inside], minlength=s.buckets)
            if fit[a:b].any():
                good = np.repeat(fit[a:b], np.diff(offsets[a : b + 1]))[: len(found)]
                target += np.bincount(found[inside & good], minlength=s.buckets)
    used = np.flatnonzero(raw)
    for k in range(0, len(used), 1 << 16):
        u = used[k : k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(raw[u]), pa.array(target[u])], names=["bucket", "raw", "target"])


@dataclass(frozen=True)
class Model:
    """Log ratios by bucket; ``weights`` scores a column of texts."""

    settings: Settings
    ratios: np.ndarray

    def weights(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(score, log_weight) of each text; texts without an n-gram score 0."""
        s = self.settings
        data, offsets = buffer(texts)
        score, plain = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for a, b in runs(offsets):
            found = buckets_of(data[offsets[a] : offsets[b]], s.gram, s.buckets)
            value = self.ratios[found].astype(np.float64)
            value[~_own(offsets, a, b, s.gram)] = 0.0
            starts = offsets[a:b] - offsets[a]
            n = np.maximum(np.diff(offsets[a : b + 1]) - s.gram + 1, 0)
            some = n > 0
            if not some.any():
                continue
            ends = starts + n
            for out, v in ((plain, value), (score, np.where(value < s.against, value, 0.0))):
                total = np.concatenate([[0.0], np.cumsum(v)])
                part = np.zeros(b - a)
                part[some] = total[ends[some]] - total[starts[some]]
                out[a:b] = part
            score[a:b][some] /= np.sqrt(n[some])
        return score, plain


def labelled(labels: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, good, aside): at most ``max_labelled`` ids. An id is good if all
    its rows say quality 1 and toxic 0; rows with a null are left out."""
    rows = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"),
    ).dropna()
    rows = rows.groupBy("doc_id").agg(F.min("good").alias("good"))
    rows = rows.withColumn("order", F.xxhash64(F.col("doc_id").cast("string"))).orderBy("order", "doc_id").limit(s.max_labelled)
    return written(rows.select("doc_id", "good", (F.pmod("order", F.lit(s.held_out)) == 0).alias("aside")), "labelled")


def fit(docs: DataFrame, marks: DataFrame, s: Settings) -> Model:
    """Count every document's n-grams and compare the two models."""
    spark = docs.sparkSession
    chosen = F.broadcast(marks.where(F.col("good") & ~F.col("aside")).select("doc_id", F.lit(True).alias("fit")))
    rows = id_and_text(docs).join(chosen, "doc_id", "left").select("text", "fit")
    counts = rows.mapInArrow(lambda it: _count(it, s), "bucket long, raw long, target long")
    total = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(s.buckets), np.zeros(s.buckets)
    found = written(total, "buckets").toArrow()  # one row per bucket at most
    at = found.column("bucket").to_numpy()
    raw[at], target[at] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    if not target.sum():
        return Model(s, np.zeros(s.buckets, dtype=np.float32))
    expected = raw / raw.sum() * target.sum()
    return Model(s, np.log((target + s.pseudo) / (expected + s.pseudo)).astype(np.float32))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Every row: doc_id, score, log_weight, key (score with its Gumbel noise).

    The noise comes from a hash of the row, so a task that runs again draws
    the same."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ``buckets`` floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        for batch in batches:
            score, plain = shared.value.weights(batch.column(1))
            key = keys(score, batch.column(2).to_numpy(zero_copy_only=False), model.settings.temperature)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(plain), pa.array(key)], names=["doc_id", "score", "log_weight", "key"]
            )

    rows = id_and_text(docs).select("doc_id", "text", _draw("doc_id", "text").alias("draw"))
    return rows.mapInArrow(run, "doc_id long, score double, log_weight double, key double")


def _draw(doc_id: str, text: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)), text)


def keys(score: np.ndarray, draw: np.ndarray, temperature: float) -> np.ndarray:
    u = ((draw.astype(np.int64).view(np.uint64) >> U64(11)).astype(np.float64) + 0.5) / 2.0**53
    return score - temperature * np.log(-np.log(u))


def best_cut(score: np.ndarray, good: np.ndarray) -> float:
    """The score from which on keeping makes fewest labelled mistakes (between
    two scores, their middle; without labels of both kinds, keep everything)."""
    if not len(score) or good.all() or not good.any():
        return -np.inf
    order = np.argsort(score, kind="stable")
    score, good = score[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(good)]) + np.concatenate([np.cumsum(~good[::-1])[::-1], [0]])
    wrong[1:-1][score[1:] == score[:-1]] = len(score) + 1  # equal scores stay together
    k = int(wrong.argmin())
    if k == 0:
        return -np.inf
    return float((score[k - 1] + score[k]) / 2) if k < len(score) else float(np.nextafter(score[-1], np.inf))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1024, few: int = 10_000) -> float:
    """The k-th largest value by repeated histograms: the driver sees ``bins``
    counts a round and at most ``few`` values at the end. Values that cannot be
    told apart (equal rows) share a threshold."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return np.inf
    for _ in range(12):
        step = (high - low) / bins
        if not step > 0:
            return low
        inside = rows.where(F.col(column).between(low, high))
        at = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1))
        counts = inside.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for row in sorted(counts.collect(), key=lambda r: -r["b"]):
            if row["n"] >= k:
                break
            k -= row["n"]
        else:
            return low
        low, high = row["lo"], row["hi"]
        if row["n"] <= few:
            values = rows.where(F.col(column).between(low, high)).select(column).toArrow().column(0).to_numpy()
            return float(np.sort(values)[::-1][k - 1])
    return low


@dataclass(frozen=True)
class Draw:
    """A fitted model with the key from which on documents are kept."""

    model: Model
    rows: DataFrame
    threshold: float


def resample(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Draw:
    """Fit, score every document and draw the k of largest key.

    Null text is empty and scores 0, like any text shorter than an n-gram;
    null doc_ids and repeated rows are scored like others; rows equal in id and
    text share their fate; without usable labels everything is kept; an empty
    table gives no rows; other columns are ignored.
    """
    s = settings or Settings()
    marks = labelled(labels, s)
    model = fit(docs, marks, s)
    rows = written(scored(docs, model), "scores")
    aside = rows.join(F.broadcast(marks.where("aside")), "doc_id").select("score", "good").toArrow()  # bounded by max_labelled
    cut = best_cut(aside.column("score").to_numpy(), aside.column("good").to_numpy(zero_copy_only=False).astype(bool))
    k = rows.where(F.col("score") >= F.lit(cut)).count()
    return Draw(model, rows, kth_largest(rows, "key", k))


def classified(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per document: doc_id, score, log_weight, kept."""
    draw = resample(docs, labels, settings)
    return draw.rows.select("doc_id", "score", "log_weight", (F.col("key") >= F.lit(draw.threshold)).alias("kept"))


def keep_drawn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The drawn documents with all their columns. Keys are computed again in
    place, so no text is shuffled."""
    draw = resample(docs, labels, settings)
    shared, least = docs.sparkSession.sparkContext.broadcast(draw.model), draw.threshold
    temperature, schema, n = draw.model.settings.temperature, docs.schema, len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        for batch in batches:
            score, _ = shared.value.weights(batch.column(n))
            key = keys(score, batch.column(n + 1).to_numpy(zero_copy_only=False), temperature)
            kept = batch.filter(pa.array(key >= least))
            yield pa.RecordBatch.from_arrays(kept.columns[:n], names=batch.schema.names[:n])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("*", text.alias("_whole")).select("*", _draw("doc_id", "_whole").alias("_draw"))
    return rows.mapInArrow(run, T.StructType(schema.fields))
