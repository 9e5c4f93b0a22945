"""Separator scan (operator 6): token counts of flat, unindexed token files.

A flat file is a run of little-endian 16-bit ids cut into blocks of fixed size,
wherever documents begin or end. Pass 1 finds the separators of each block with
one vectorised comparison and keeps their positions. Two block facts (ids,
place of the last separator) go through a prefix scan over the blocks of a
file, in two levels so that no file's blocks meet in one task, and the carry
turns the first separator of each block into a whole document. Pass 2 works on
positions only; the ids are read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.bpe import encoder
from marquee.llm.common import id_and_text, written

BLOCK_BYTES = 1 << 20
BLOCKS_PER_GROUP = 1024
BLOCKS = "file_id long, block_no long, data binary, doc_ids array<long>"
SCANNED = "file_id long, block_no long, n_ids long, ends array<int>, doc_ids array<long>"


def _flatten(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    if max(enc.vocab, end_id + 1) > 1 << 16:
        raise ValueError("flat files hold 16-bit ids")
    end, file_id, block = np.array([end_id], dtype="<u2").tobytes(), TaskContext.get().partitionId(), 0
    held, ended = bytearray(), []  # ended: (byte where the document ends, doc_id)
    schema = pa.schema([("file_id", pa.int64()), ("block_no", pa.int64()), ("data", pa.binary()), ("doc_ids", pa.list_(pa.int64()))])

    def flush(size: int) -> pa.RecordBatch:
        nonlocal held, ended, block
        row = {"file_id": [file_id], "block_no": [block], "data": [bytes(held[:size])], "doc_ids": [[d for e, d in ended if e <= size]]}
        held, ended, block = held[size:], [(e - size, d) for e, d in ended if e > size], block + 1
        return pa.RecordBatch.from_pydict(row, schema=schema)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held += enc.encode([text.as_py()])[0].astype("<u2").tobytes() + end
            ended.append((len(held), doc_id))
            while len(held) >= block_bytes:
                yield flush(block_bytes)
    if held:
        yield flush(block_bytes)


def flat_files(docs: DataFrame, tokenizer: str, end_id: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents as flat token files, one per scan partition, in blocks.

    ``doc_ids`` names the documents whose separator lies in the block; the scan
    never looks at it, it only lets a caller name what the scan finds.
    """
    rows = id_and_text(docs).mapInArrow(lambda it: _flatten(it, tokenizer, end_id, block_bytes), BLOCKS)
    return written(rows, "flat")


def _find(batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [np.frombuffer(d.as_py(), dtype="<u2") for d in batch.column(2)]
        ends = [np.flatnonzero(x == end_id).astype(np.int32) for x in ids]
        cols = [batch.column(0), batch.column(1), pa.array([len(x) for x in ids], pa.int64()), pa.array(ends, pa.list_(pa.int32())), batch.column(3)]
        yield pa.RecordBatch.from_arrays(cols, names=["file_id", "block_no", "n_ids", "ends", "doc_ids"])


def separator_scan(blocks: DataFrame, end_id: int) -> DataFrame:
    """Documents of flat files: file_id, start (ids before it in its file),
    n_tokens (without the separator), closed (false: the file ends without one),
    doc_id (null where the blocks do not name it).

    An empty file has no rows; two separators in a row bound an empty document;
    a document may span any number of blocks.
    """
    found = written(blocks.mapInArrow(lambda it: _find(it, end_id), SCANNED), "ends")
    group = F.floor(F.col("block_no") / BLOCKS_PER_GROUP).alias("grp")
    # last: ids after which the last separator of the block ends, counted from the block's start
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1).cast("long") + 1)
    facts = found.select("file_id", "block_no", group, "n_ids", last.alias("last"))
    in_group = Window.partitionBy("file_id", "grp").orderBy("block_no")
    before = in_group.rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    facts = facts.withColumn("at", at)
    facts = facts.withColumn("sep", F.max(F.col("at") + F.col("last")).over(before))
    groups = facts.groupBy("file_id", "grp").agg(
        F.sum("n_ids").alias("g_ids"),
        F.max(F.col("at") + F.col("last")).alias("g_last"),
        F.max("block_no").alias("g_block"),
    )
    whole = Window.partitionBy("file_id").orderBy("grp")
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("g_at", F.coalesce(F.sum("g_ids").over(earlier), F.lit(0)))
    groups = groups.withColumn("g_sep", F.max(F.col("g_at") + F.col("g_last")).over(earlier))
    groups = groups.withColumn("f_block", F.max("g_block").over(Window.partitionBy("file_id")))
    carry = facts.join(groups, ["file_id", "grp"]).select(
        "file_id",
        "block_no",
        (F.col("g_at") + F.col("at")).alias("block_at"),
        # where the document open at the block's start began
        F.coalesce(F.col("g_at") + F.col("sep"), F.col("g_sep"), F.lit(0)).alias("open_at"),
        (F.col("block_no") == F.col("f_block")).alias("final"),
    )
    joined = found.join(carry, ["file_id", "block_no"])
    stop = F.col("block_at") + F.col("e").cast("long")
    begun = F.when(F.col("i") == 0, F.col("open_at")).otherwise(F.col("block_at") + F.get("ends", F.col("i") - 1) + 1)
    closed = joined.select("*", F.posexplode("ends").alias("i", "e")).select(
        "file_id",
        begun.cast("long").alias("start"),
        (stop - begun).cast("long").alias("n_tokens"),
        F.lit(True).alias("closed"),
        F.get("doc_ids", F.col("i")).alias("doc_id"),
    )
    end_at = F.col("block_at") + F.col("n_ids")
    tail = F.coalesce(F.col("block_at") + F.element_at(F.col("ends"), -1) + 1, F.col("open_at"))
    tail = F.when(F.size("ends") > 0, tail).otherwise(F.col("open_at"))
    opened = joined.where(F.col("final") & (tail < end_at)).select(
        "file_id",
        tail.cast("long").alias("start"),
        (end_at - tail).cast("long").alias("n_tokens"),
        F.lit(False).alias("closed"),
        F.lit(None).cast("long").alias("doc_id"),
    )
    return closed.unionByName(opened)
