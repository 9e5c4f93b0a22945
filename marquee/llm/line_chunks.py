"""Content-defined line chunks (operator 4).

Every line with text is hashed, and a hash rolls over each ``SPAN`` neighbouring
line hashes of a document. ``SEEDS`` boundary functions read it: for each of
them half of the windows open a chunk at their first line and half close one at
their last. A chunk runs from the last opening before a closing to the first
closing after it. Its boundaries follow from its own lines alone, so lines put
in, taken out or differing around it move nothing, and whatever two documents
share is cut in the same places. A function starts a chunk at a third of the lines
of a long run; together they miss a run of two lines with probability
(3/4)^SEEDS, and the ends of long runs with (2/3)^SEEDS.

Chunks are compared over the whole corpus: hash shards find the repeated ones
and name the first document that holds each; that document sends the chunk's
bytes once, all others are compared with them, and only byte-equal repeats are
removed. The chunks of one function overlap by one line at most, so what is
sent grows with the lines, however often a line repeats.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import blobs, exchange
from marquee.llm.common import partitions
from marquee.llm.textnp import SPACES, U64, buffer, mix, runs, span_hashes

SPAN = 2  # line hashes in the rolling hash, and the fewest lines of a chunk
SEEDS = 16  # boundary functions
_FACTOR = 0x9E3779B97F4A7C15
RESULT = "doc_id long, text string, n_lines long, n_removed long"
_NO_ID = -(1 << 62)


def boundaries(hashes: np.ndarray, row: np.ndarray, seeds: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of all distinct chunks that the boundary functions
    find among the line hashes, ascending; none crosses a row."""
    found = [np.zeros((0, 2), dtype=np.int64)]
    n = len(hashes) - SPAN + 1
    if n > 0:
        roll = np.zeros(n, dtype=np.uint64)
        for j in range(SPAN):
            roll = roll * U64(_FACTOR) + hashes[j : j + n]
        whole = row[SPAN - 1 :] == row[:n]
        place = np.arange(n)
        for seed in range(seeds):
            bits = mix(roll + U64((seed + 1) * _FACTOR % (1 << 64)))
            opens, closes = whole & (bits & U64(1) == 1), whole & (bits & U64(2) == 2)
            opened = np.maximum.accumulate(np.where(opens, place, -1))
            ends = np.flatnonzero(closes & (opened >= 0))
            begin, at = np.unique(opened[ends], return_index=True)  # the first closing of each opening
            end = ends[at]
            same = row[begin] == row[end]
            found.append(np.stack([begin[same], end[same] + SPAN - 1], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


class Run:
    """Lines and chunks of neighbouring texts: ``data`` with the texts' offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: int):
        breaks = np.flatnonzero(data == 10)
        # a line begins at each text's start and after each line end
        rows = np.searchsorted(offsets, breaks, side="right") - 1
        starts = np.concatenate([offsets[:-1], breaks + 1])
        ends = np.concatenate([breaks, offsets[1:]])
        row = np.concatenate([np.arange(len(offsets) - 1), rows])
        order = np.lexsort((starts, row))
        self.line_starts, self.line_row = starts[order], row[order]
        # within a row the k-th line ends where its k-th break is, the last at the text's end
        end_row = np.concatenate([rows, np.arange(len(offsets) - 1)])
        self.line_ends = ends[np.lexsort((ends, end_row))]
        inked = np.concatenate([[0], np.cumsum(~SPACES[data])])
        lines = np.flatnonzero(inked[self.line_ends] > inked[self.line_starts])  # only these open and close chunks
        first, last = boundaries(span_hashes(data, self.line_starts[lines], self.line_ends[lines]), self.line_row[lines], seeds)
        self.first_line, self.last_line = lines[first], lines[last]


class Chunks:
    """The chunks of a block's texts, in row order."""

    def __init__(self, texts: pa.ChunkedArray, seeds: int = SEEDS):
        self.data, offsets = buffer(texts)
        bounds = list(runs(offsets)) or [(0, 0)]
        parts = [Run(self.data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], seeds) for a, b in bounds]
        lines = np.cumsum([0] + [len(p.line_row) for p in parts])

        def every(name: str, shifts: Iterable[int]) -> np.ndarray:
            return np.concatenate([getattr(p, name) + s for p, s in zip(parts, shifts, strict=False)])

        self.line_starts, self.line_ends = (every(n, (offsets[a] for a, _ in bounds)) for n in ("line_starts", "line_ends"))
        self.line_row = every("line_row", (a for a, _ in bounds))
        self.first_line, self.last_line = (every(n, lines) for n in ("first_line", "last_line"))
        self.row = self.line_row[self.first_line]
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Of the bytes of each chunk, taken line by line (with the white lines between)."""
        h = span_hashes(self.data, self.line_starts, self.line_ends)
        out = np.zeros(len(self.first_line), dtype=np.uint64)
        at, left = self.first_line.copy(), np.arange(len(self.first_line))
        while len(left):
            out[left] = mix(out[left] * U64(_FACTOR) + h[at[left]])
            at[left] += 1
            left = left[at[left] <= self.last_line[left]]
        return out

    def text(self, chunk: int) -> bytes:
        return self.data[self.line_starts[self.first_line[chunk]] : self.line_ends[self.last_line[chunk]]].tobytes()


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(_NO_ID).to_numpy()


def _keys(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    table = exchange.ordered(table)
    chunks, ids = Chunks(table.column("text")), _ids(table)
    found, first, n = np.unique(chunks.hashes, return_index=True, return_counts=True)
    return found, [ids[chunks.row[first]], n > 1]


def _owners(keys: list[np.ndarray], values: list[list[np.ndarray]], blocks: list[int]) -> list[list[np.ndarray]]:
    """0: found once; 1: repeated, and this block holds the first; 2: repeated."""
    size = [len(k) for k in keys]
    every, ids = np.concatenate(keys), np.concatenate([v[0] for v in values])
    many, block = np.concatenate([v[1] for v in values]), np.repeat(blocks, size)
    order = np.lexsort((block, ids, every))
    ranked = every[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    group = np.cumsum(first) - 1
    repeated = (np.bincount(group) > 1) | (np.bincount(group, many[order]) > 0)
    code = np.empty(len(every), dtype=np.uint8)
    code[order] = np.where(repeated[group], np.where(first, 1, 2), 0)
    return [[c] for c in np.split(code, np.cumsum(size)[:-1])]


def _repeats(table: pa.Table, codes: pa.Table) -> tuple[Chunks, np.ndarray, np.ndarray]:
    """Of a block in its order: its chunks, which of them are the corpus's
    first of a repeated one, and which are repeats. A repeat that shares a line
    with the first one (lines that repeat at once) is neither: it would take
    lines of the occurrence that stays."""
    chunks = Chunks(table.column("text"))
    found, first, back = np.unique(chunks.hashes, return_index=True, return_inverse=True)
    given = exchange.answers(codes)
    code = given[0] if given else np.zeros(0, np.uint8)
    repeated = code[back] > 0 if len(found) else np.zeros(0, bool)
    origin = np.zeros(len(chunks.hashes), dtype=bool)
    origin[first[code == 1]] = True
    if len(found):
        holder = first[back]
        shares = (chunks.row == chunks.row[holder]) & (chunks.first_line <= chunks.last_line[holder])
        repeated &= origin | ~(shares & (code[back] == 1))
    return chunks, origin, repeated & ~origin


def _outer(chunks: Chunks, repeats: np.ndarray) -> np.ndarray:
    """The repeats that lie in no other repeat: removing those removes all."""
    k = np.flatnonzero(repeats)
    k = k[np.lexsort((-chunks.last_line[k], chunks.first_line[k]))]
    if not len(k):
        return k
    reach = np.maximum.accumulate(chunks.last_line[k])
    return k[np.concatenate([[True], chunks.last_line[k[1:]] > reach[:-1]])]


def _claim(table: pa.Table, codes: pa.Table, shards: int) -> pa.Table:
    """The bytes of the block's first and repeated chunks, to the shards of their hashes."""
    block = exchange.block_of(table)
    chunks, origin, repeats = _repeats(exchange.ordered(table), codes)
    sent: dict[int, list[tuple[int, bool, bytes]]] = {}
    seen = set()
    for k in [*np.flatnonzero(origin).tolist(), *_outer(chunks, repeats).tolist()]:
        entry = int(chunks.hashes[k]), bool(origin[k]), chunks.text(k)
        if entry not in seen:
            seen.add(entry)
            shard = int(exchange.shard_of(chunks.hashes[k : k + 1], shards)[0])
            sent.setdefault(shard, []).append(entry)

    def rows() -> Iterator[tuple[int, int, bytes]]:
        for shard, entries in sent.items():
            h, own, raw = zip(*entries, strict=True)
            sizes = np.array([len(r) for r in raw], dtype="<u4")
            text = np.frombuffer(b"".join(raw), np.uint8)
            yield shard, block, blobs.pack(np.array(h, np.uint64), np.array(own, bool), sizes, text)

    return exchange.routed(rows())


def _compare(table: pa.Table) -> pa.Table:
    """Hashes of each block whose every text equals the first document's."""
    origin: dict[int, bytes] = {}
    blocks, claims = table.column("block").to_pylist(), []
    for data in table.column("data"):
        h, own, sizes, text = blobs.unpack(data.as_py())
        ends = np.cumsum(sizes.astype(np.int64))
        raw = [text[e - s : e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
        origin |= {int(k): r for k, o, r in zip(h, own, raw, strict=True) if o}
        claims.append(list(zip(h.tolist(), raw, strict=True)))
    rows = []
    for block, pairs in zip(blocks, claims, strict=True):
        unlike = {k for k, r in pairs if origin.get(k) != r}
        equal = np.array(sorted({k for k, _ in pairs} - unlike), dtype=np.uint64)
        rows.append((block, table.column("shard")[0].as_py(), blobs.pack(equal, ascending=(0,))))
    return exchange.answered(rows)


def _cut(table: pa.Table, codes: pa.Table, equal: pa.Table) -> pa.Table:
    """The block's rows without the repeats whose bytes were equal."""
    table = exchange.ordered(table)
    chunks, _, repeats = _repeats(table, codes)
    given = exchange.answers(equal)
    gone = _outer(chunks, repeats)
    gone = gone[np.isin(chunks.hashes[gone], given[0] if given else [])]
    dropped = np.zeros(len(chunks.line_row) + 1, dtype=np.int64)
    np.add.at(dropped, chunks.first_line[gone], 1)
    np.add.at(dropped, chunks.last_line[gone] + 1, -1)
    dropped = np.cumsum(dropped[:-1]) > 0
    n_lines = np.bincount(chunks.line_row, minlength=table.num_rows)
    n_removed = np.bincount(chunks.line_row[dropped], minlength=table.num_rows)
    texts = table.column("text").to_pylist()
    at = np.concatenate([[0], np.cumsum(n_lines)])
    for r in np.flatnonzero(n_removed).tolist():
        lines = texts[r].split("\n")
        texts[r] = "\n".join([x for x, d in zip(lines, dropped[at[r] : at[r + 1]], strict=True) if not d])
    cols = [table.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines), pa.array(n_removed)]
    names = ["doc_id", "text", "n_lines", "n_removed"]
    kept = [c for c in table.column_names if c not in ("block", "doc_id", "text")]
    return pa.Table.from_arrays(cols + [table.column(c) for c in kept], names=names + kept)


def remove_repeated_chunks(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its repeated chunks cut out: doc_id, text (the lines left),
    n_lines, n_removed, and the ``extra`` columns as they came.

    The first occurrence, by (doc_id, text, place), stays; a repeat inside one
    document goes too, unless it shares a line with the first. Null text is
    empty; null doc_ids come first; repeated rows lose their chunks from the
    second row on; lines of white space alone open and close no chunk (between
    two others they belong to it), and single lines are left alone; an empty
    table gives no rows; columns not asked for are left behind. Repeats are
    judged on the input.
    """
    blocked, back = exchange.blocks(docs, extra)
    shards = partitions(docs.sparkSession)
    codes = exchange.ask(blocked, _keys, _owners, shards)

    claims = exchange.finish(blocked, {"codes": codes}, lambda t, r: _claim(t, r["codes"], shards), exchange.ROUTED)
    equal = claims.repartition(shards, "shard").groupBy("shard").applyInArrow(_compare, exchange.ANSWER)
    schema = RESULT + "".join(f", {c} {blocked.schema[c].dataType.simpleString()}" for c in back)
    done = exchange.finish(blocked, {"codes": codes, "equal": equal}, lambda t, r: _cut(t, r["codes"], r["equal"]), schema)
    return done.select("doc_id", "text", "n_lines", "n_removed", *[F.col(c).alias(name) for c, name in back.items()])
