"""Blocks of documents ask hash shards, and get their answers back.

Corpus statistics over hundreds of words per document are too many rows to
explode. Here a *block* is a group of documents dealt by a hash of (doc_id,
text): its size never depends on the content. A block sends each shard the
distinct keys it holds in that shard's hash range, as one packed row; a shard
sees every block's keys of its range, and returns one packed row of answers to
each block. A word, line or passage that a third of the corpus shares is thus
one key per block, not one row per document, and nothing is broadcast or
collected.

Blocks are identified by content, and keys are sorted sets, so a task that is
run again sends the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import blobs
from marquee.llm.common import begin, partitions, trim

ROUTED = "shard int, block int, data binary"
ANSWER = "block int, shard int, data binary"
_ROUTED = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("data", pa.binary())])
_ANSWER = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("data", pa.binary())])


def blocks(docs: DataFrame, extra: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """(block, doc_id, text, x0, x1, ...) with all rows of a block in one
    partition, and which of the ``extra`` columns each xN carries.

    The key holds the text too, so rows that share a doc_id (or have none)
    still spread."""
    n = partitions(docs.sparkSession)
    back = {f"x{k}": name for k, name in enumerate(extra)}
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        *[docs[name].alias(x) for x, name in back.items()],
    )
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block")
    return rows.select(block, "*").repartition(n, "block"), back


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: equal ranges of the hash space, ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def cuts(sorted_keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin and end among sorted keys (shards + 1 places)."""
    return np.searchsorted(shard_of(sorted_keys, shards), np.arange(shards + 1))


def routed(rows: Iterator[tuple[int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _ROUTED.types, strict=True)], schema=_ROUTED)


def answered(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _ANSWER.types, strict=True)], schema=_ANSWER)


def block_of(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def ask(
    blocked: DataFrame,
    keys: Callable[[pa.Table], tuple[np.ndarray, list[np.ndarray]]],
    answer: Callable[[list[np.ndarray], list[list[np.ndarray]], list[int]], list[list[np.ndarray]]],
    shards: int,
    bits: int = 64,
) -> DataFrame:
    """(block, shard, data): the answers to every block's distinct keys.

    ``keys(table of a block)`` gives ascending distinct uint64 keys and arrays
    of values that go with them. ``answer(keys of each block, their values,
    block ids)`` gives, for each block, arrays aligned with its keys. ``bits``
    below 64 rounds the keys down for the journey: for answers that may mix up
    keys with the same leading bits. Read the answers with ``answers``.
    """

    def run(table: pa.Table) -> pa.Table:
        begin()
        out = send(block_of(table), *keys(table), shards, bits)
        trim()
        return out

    return reply(blocked.groupBy("block").applyInArrow(run, ROUTED), answer, shards)


def send(block: int, keys: np.ndarray, values: list[np.ndarray], shards: int, bits: int = 64, every: bool = False) -> pa.Table:
    """One routed row per shard that has any of the ascending keys (``every``:
    to all shards, so that all of them answer every block)."""
    begin()
    drop, at = np.uint64(64 - bits), cuts(keys, shards)

    def rows() -> Iterator[tuple[int, int, bytes]]:
        for s in range(shards):
            a, b = at[s], at[s + 1]
            if a < b or every:
                yield s, block, blobs.pack(keys[a:b] >> drop, *(v[a:b] for v in values), ascending=(0,))

    return routed(rows())


def reply(sent: DataFrame, answer: Callable, shards: int) -> DataFrame:
    """What the shards answer to routed rows, back by block (see ``ask``)."""

    def run(table: pa.Table) -> pa.Table:
        begin()
        shard = table.column("shard")[0].as_py()
        ids = table.column("block").to_pylist()
        found = [blobs.unpack(d.as_py()) for d in table.column("data")]
        given = answer([x[0] for x in found], [x[1:] for x in found], ids)
        out = answered([(i, shard, blobs.pack(*a)) for i, a in zip(ids, given, strict=True)])
        del found, given
        trim()
        return out

    return sent.repartition(shards, "shard").groupBy("shard").applyInArrow(run, ANSWER)


def answers(table: pa.Table) -> list[np.ndarray]:
    """All shards' answers to one block, in the order of its keys (shards
    divide the hash space in ascending ranges)."""
    rows = sorted(zip(table.column("shard").to_pylist(), table.column("data"), strict=True), key=lambda r: r[0])
    parts = [blobs.unpack(d.as_py()) for _, d in rows]
    return [np.concatenate(p) for p in zip(*parts, strict=True)] if parts else []


def merged(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all blocks, and the sum of their values."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every, value = every[order], np.concatenate(values)[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(value, first) if len(first) else value[:0]


def ordered(table: pa.Table) -> pa.Table:
    """A block's rows in the one order every pass agrees on."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def finish(
    blocked: DataFrame,
    replies: dict[str, DataFrame],
    work: Callable[[pa.Table, dict[str, pa.Table]], pa.Table],
    schema: str,
) -> DataFrame:
    """``work(block's rows, what each reply frame returned to the block)``.

    The same ``blocked`` frame everywhere lets Spark shuffle the texts once."""
    tagged = None
    for name, rows in replies.items():
        rows = rows.select(F.lit(name).alias("kind"), "block", "shard", "data")
        tagged = rows if tagged is None else tagged.unionByName(rows)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return empty
        begin()
        kinds = np.array(right.column("kind").to_pylist(), dtype=object)
        out = work(left, {k: right.filter(pa.array(kinds == k, pa.bool_())) for k in names})
        trim()
        return out

    names, empty = list(replies), _empty(blocked, schema)
    return blocked.groupBy("block").cogroup(tagged.groupBy("block")).applyInArrow(run, schema)


def _empty(frame: DataFrame, schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema)).empty_table()
