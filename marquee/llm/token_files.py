"""Fixed-width bit packing of token ids, with block offsets (operator 3).

A segment is one byte string, little-endian throughout:

    magic 4 bytes | bits u32 | block u32 | n_docs u32 | n_ids u64
    doc_ids   i64[n_docs]
    doc_ends  u64[n_docs]      ids up to and with each document
    blocks    u64[n_blocks+1]  byte offset of each block in the payload
    payload                    ids in ``bits`` bits each, blocks padded to 8 bytes

``bits`` is the least width that holds every id of the vocabulary. A block is
unpacked with numpy alone and without its neighbours, which gives random access
to any id range. Segments are rows of a Parquet table (``part``, ``seg``,
``start_in_part``, ``n_ids``, ``n_docs``, ``data``), so any store Spark can
write holds them and a reader prunes to the segments it needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bpe import encoder
from marquee.llm.common import id_and_text, partitions, scratch

MAGIC = b"MQTK"
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
SEGMENTS = "part int, seg int, start_in_part long, n_ids long, n_docs int, data binary"


def width(vocab: int) -> int:
    """Bits of the largest id of a vocabulary of that size."""
    return max(1, (vocab - 1).bit_length())


def pack_block(ids: np.ndarray, bits: int) -> np.ndarray:
    """Values (< 2**bits, bits <= 63) as 64-bit words, 64 values to ``bits`` words."""
    rows = -(-len(ids) // 64)
    grid = np.zeros(rows * 64, dtype=np.uint64)
    grid[: len(ids)] = ids
    grid = grid.reshape(rows, 64)
    out = np.zeros((rows, bits), dtype=np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= grid[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= grid[:, j] >> np.uint64(64 - shift)
    return out.ravel()


def unpack_words(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first n of the packed values, as 64-bit integers."""
    rows = len(words) // bits
    words = words.reshape(rows, bits)
    out = np.empty((rows, 64), dtype=np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, j] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            out[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    return out.ravel()[:n] & np.uint64((1 << bits) - 1)


def pack_segment(doc_ids: list[int], docs: list[np.ndarray], bits: int, block: int = BLOCK_IDS) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, dtype="<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if block % 64:
        raise ValueError("a block holds a multiple of 64 ids")  # so that blocks meet at whole words
    payload = pack_block(ids, bits).astype("<u8")
    offsets = np.minimum(np.arange(-(-len(ids) // block) + 1) * (block * bits // 8), 8 * len(payload)).astype("<u8")
    head = np.array([bits, block, len(docs)], dtype="<u4").tobytes() + np.array([len(ids)], dtype="<u8").tobytes()
    ends = np.cumsum([len(d) for d in docs]).astype("<u8")
    parts = [MAGIC, head, np.array(doc_ids, dtype="<i8").tobytes(), ends.tobytes(), offsets.tobytes()]
    return b"".join([*parts, payload.tobytes()])


class Segment:
    """Reads one segment; ``ids(a, b)`` unpacks only the blocks it needs."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a packed segment")
        self.bits, self.block, n_docs = (int(x) for x in np.frombuffer(data, "<u4", 3, 4))
        self.n_ids = int(np.frombuffer(data, "<u8", 1, 16)[0])
        at = 24
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        self.doc_ends = np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
        at += 16 * n_docs
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.data, self.payload = data, at + 8 * (n_blocks + 1)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block, (stop - 1) // self.block
        at, end = int(self.offsets[first]), int(self.offsets[last + 1])
        words = np.frombuffer(self.data, "<u8", (end - at) // 8, self.payload + at)
        held = unpack_words(words, self.bits, min((last + 1) * self.block, self.n_ids) - first * self.block)
        return held[start - first * self.block : stop - first * self.block].astype("<u4")


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, end_id: int, segment: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, as_text=False)
    bits, part = width(max(enc.vocab, end_id + 1)), TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4")
    seg = start = held = 0
    ids: list[int] = []
    docs: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        row = [part], [seg], [start], [held], [len(docs)], [pack_segment(ids, docs, bits)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, _TYPES, strict=True)], names=_NAMES)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            doc = np.concatenate([enc.encode([text.as_py()])[0], end])
            ids.append(doc_id)
            docs.append(doc)
            held += len(doc)
            if held >= segment:
                yield flush()
                seg, start, held, ids, docs = seg + 1, start + held, 0, [], []
    if docs:
        yield flush()


_NAMES = ["part", "seg", "start_in_part", "n_ids", "n_docs", "data"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_NO_ID = -(1 << 63)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, segment_ids: int = SEGMENT_IDS
) -> None:
    """Encode every whole text, append ``end_id`` and write packed segments to
    ``path`` in ascending (doc_id, text) order: partition order, then segment
    order, then order inside a segment.

    Null text is an empty document; a null doc_id sorts first and reads back as
    null; repeated rows are kept, one after the other. A document is never
    split between segments.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs)
    rows = rows.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), "text")
    ranged = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(lambda it: _pack_partition(it, tokenizer, end_id, segment_ids), SEGMENTS).write.parquet(path)


def part_offsets(segments: DataFrame) -> DataFrame:
    """(part, part_start): ids before each partition. One row per partition
    goes through the driver for the prefix sum, never documents."""
    spark = segments.sparkSession
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts = np.concatenate([[0], np.cumsum([r["n"] for r in totals])]).tolist()
    rows = [(r["part"], s) for r, s in zip(totals, starts, strict=False)]
    return spark.createDataFrame(rows, "part int, part_start long")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long, segment_start long"


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            seg = Segment(data.as_py())
            ids = seg.ids()
            ends = seg.doc_ends
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            names = np.ma.masked_equal(seg.doc_ids, _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.data, pa.int64(), mask=np.ma.getmaskarray(names)),
                    pa.array(base + starts),
                    pa.array(ends - starts),
                    pa.array(crc, pa.int64()),
                    pa.array(np.full(len(ends), base, dtype=np.int64)),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "segment_start"],
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents
    before it), n_tokens with the end id, ids_crc32, segment_start."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    starts = part_offsets(segments)
    placed = segments.join(F.broadcast(starts), "part")  # one row per partition
    return placed.select((F.col("part_start") + F.col("start_in_part")).alias("base"), "data").mapInArrow(
        _read_segments, READ
    )


def packed_token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the whole table in the shared folder and read it back."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(spark, path)
