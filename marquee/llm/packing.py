"""Concatenate and cut (operator 5).

Pass 1 encodes every document once and writes (part, start_in_part, doc_id,
ids) to the shared folder: ``part`` is the scan partition, ``start_in_part``
the running count of ids inside it. The driver turns one total per partition
into global offsets by a prefix sum. Pass 2 is then row-local: a document at
global offset g covers the windows g // n .. (g + length - 1) // n, and every
overlap is a boundary record. Nothing is shuffled or sorted; only the last
sequence is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.bpe import encoder
from marquee.llm.common import id_and_text, written

ENCODED = "part int, start_in_part long, doc_id long, n_ids long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, as_text=False)
    kind = np.dtype("<u2" if max(enc.vocab, end_id + 1) <= 1 << 16 else "<u4")
    end, part, at = np.array([end_id], dtype=kind).tobytes(), TaskContext.get().partitionId(), 0
    for batch in batches:
        raw = [enc.encode([t.as_py()])[0].astype(kind).tobytes() + end for t in batch.column(1)]
        n = np.array([len(r) // kind.itemsize for r in raw], dtype=np.int64)
        starts = at + np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64) if len(n) else n
        at += int(n.sum())
        cols = [pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(starts), batch.column(0), pa.array(n), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["part", "start_in_part", "doc_id", "n_ids", "ids"])


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Every document's ids with ``end_id`` appended, as a table in the shared
    folder (little-endian, two bytes an id where the vocabulary allows)."""
    rows = id_and_text(docs).mapInArrow(lambda it: _encode(it, tokenizer, end_id), ENCODED)
    return written(rows, "encoded")


def offsets(table: DataFrame) -> DataFrame:
    """(part, part_start) by a prefix sum over one total per partition."""
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()
    rows = [(r["part"], s) for r, s in zip(totals, starts, strict=False)]
    return table.sparkSession.createDataFrame(rows, "part int, part_start long")


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for at, doc_id, n, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), strict=True):
            size = len(raw.as_py()) // n
            ids = np.frombuffer(raw.as_py(), dtype=f"<u{size}").astype("<u4")
            whole = memoryview(ids.tobytes())
            first, last = at // window, (at + n - 1) // window
            for seq in range(first, last + 1):
                a, b = max(at, seq * window), min(at + n, (seq + 1) * window)
                crc = zlib.crc32(whole[4 * (a - at) : 4 * (b - at)])
                rows.append((doc_id, a - at, b - a, crc, n, seq, a - seq * window))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 7, names=names)


def concatenate_and_cut(docs: DataFrame, tokenizer: str, end_id: int, window: int = 1024) -> DataFrame:
    """One boundary record per piece of a document in a sequence of ``window`` ids.

    Null text is an empty document (its end id alone). Null doc_ids, repeated
    rows and ties are documents like any other; an empty table gives no rows.
    Every id lies in exactly one piece, sequences are gapless, and all but the
    last are full.
    """
    table = encoded(docs, tokenizer, end_id)
    placed = table.join(F.broadcast(offsets(table)), "part")  # one row per partition
    rows = placed.select((F.col("part_start") + F.col("start_in_part")).alias("at"), "doc_id", "n_ids", "ids")
    return rows.mapInArrow(lambda it: _cut(it, window), PIECES)
