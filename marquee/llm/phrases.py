"""Repeated-phrase automata (operator 8).

A word is removed if a window of ``WINDOW`` words that covers it also begins in
a document with a smaller doc_id.

1. Blocks ask hash shards about the hashes of all their windows. For a window
   found in two or more documents the answer is its owner: the smallest doc_id.
2. Runs of recurring windows become passages (in the owner) and claims (in
   later documents), as words. Both go to the shard of their owner and level; a
   claim that many documents of a block share is sent once. The level of a
   window says how many texts hold it: beyond ``SHARED`` the claims are dealt to
   two, four, ... cells of other shards, and the owner's passage goes to each.
3. A shard compiles Aho-Corasick automata over the windows of its passages, a
   character a word, and streams the claims through their owner's. Every match is a confirmed
   occurrence, so equal hashes of unequal words remove nothing.
4. The confirmed spans return to their blocks and the words are cut.

Shards follow the session's shuffle setting; an automaton has a fixed size, or
that of one owner's passages. A cell holds about ``SHARED`` texts' claims on one owner,
however many near copies there are; all agree on the level of a window, since
one shard counts it. An owner is a doc_id: rows that share one (or have none)
share its cells.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import blobs, exchange
from marquee.llm.common import partitions
from marquee.llm.textnp import U64, Words, gram_hashes, gram_starts, mix, span_hashes

WINDOW = 13
SHARED = 64  # texts that claim a window in one cell
AUTOMATON = 1 << 17  # bytes of passages in an automaton; one owner's stay together
RESULT = "doc_id long, n_words long, n_removed long, kept string"
_NO_ID = -(1 << 62)  # stands for a null doc_id: before all others
_NONE = (1 << 63) - 1


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(_NO_ID).to_numpy()


class Windows:
    """All windows of a block in its order, by hash."""

    def __init__(self, table: pa.Table, size: int):
        self.words, self.ids = Words(table.column("text")), _ids(table)
        self.starts = gram_starts(self.words.offsets, size)
        hashes = gram_hashes(self.words.hashes(), size)
        self.hashes = hashes[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
        self.row = np.searchsorted(self.words.offsets, self.starts, side="right") - 1

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, smallest doc_id, whether in several documents, number of
        different texts); rows ascend by doc_id, so the first place of a key is
        its smallest."""
        order = np.argsort(self.hashes, kind="stable")
        ranked = self.hashes[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else order
        ids = self.ids[self.row[order]]
        last = np.concatenate([first[1:], [len(ranked)]]) - 1 if len(first) else first
        row = self.row[order]
        counted = self._news()[row]
        counted[1:] &= (ranked[1:] != ranked[:-1]) | (row[1:] != row[:-1])
        texts = np.add.reduceat(counted, first, dtype="<u4") if len(first) else np.zeros(0, "<u4")
        return ranked[first], ids[first], ids[last] != ids[first], texts

    def _news(self) -> np.ndarray:
        """Which rows are the first of the block with their text."""
        offsets = self.words.text_offsets
        _, first = np.unique(span_hashes(self.words.data, offsets[:-1], offsets[1:]), return_index=True)
        news = np.zeros(len(offsets) - 1, dtype=bool)
        news[first] = True
        return news


def _owners(keys: list[np.ndarray], values: list[list[np.ndarray]], blocks: list[int]) -> list[list[np.ndarray]]:
    """For each block: which keys recur (in two or more documents), and the
    owners and levels of those."""
    size = [len(k) for k in keys]
    every, ids, many, texts = (np.concatenate(x) for x in (keys, *([v[k] for v in values] for k in range(3))))
    order = np.argsort(every, kind="stable")
    ranked, ids, many, texts = every[order], ids[order], many[order], texts[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
    recurs = (low != high) | np.logical_or.reduceat(many, first)
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ranked))))
    cells = np.maximum(np.add.reduceat(texts, first, dtype=np.int64) / SHARED, 1)
    levels = np.ceil(np.log2(cells)).astype(np.uint8)
    flag, owner, level = np.empty(len(every), bool), np.empty(len(every), np.int64), np.empty(len(every), np.uint8)
    flag[order], owner[order], level[order] = recurs[group], low[group], levels[group]
    at = np.cumsum(size)[:-1]
    return [[f, o[f], x[f]] for f, o, x in zip(*(np.split(a, at) for a in (flag, owner, level)), strict=True)]


def _runs(member: np.ndarray, windows: Windows, owner: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run: neighbours in one row with one owner and level."""
    k = np.flatnonzero(member)
    if not len(k):
        return k, k
    joined = (np.diff(k) == 1) & (windows.row[k[1:]] == windows.row[k[:-1]]) & (owner[k[1:]] == owner[k[:-1]])
    joined &= level[k[1:]] == level[k[:-1]]
    cut = np.flatnonzero(~joined)
    return k[np.concatenate([[0], cut + 1])], k[np.concatenate([cut, [len(k) - 1]])]


def _text(words: Words, a: int, b: int) -> bytes:
    """Words a..b parted by single spaces."""
    return b" ".join(words.data[words.starts[a] : words.ends[b]].tobytes().split())


def _shards(owner: int, level: int, cells: np.ndarray, shards: int) -> list[int]:
    """The shards of an owner's cells at a level; cell 0 of level 0 goes by the owner alone."""
    key = np.array([owner], np.int64).view(np.uint64) + cells.astype(np.uint64) * U64(0x9E3779B97F4A7C15) + U64(level << 56)
    return exchange.shard_of(mix(key), shards).tolist()


def _claims(table: pa.Table, answer: pa.Table, size: int, shards: int) -> pa.Table:
    block, windows = exchange.block_of(table), Windows(exchange.ordered(table), size)
    keys = np.unique(windows.hashes)
    given = exchange.answers(answer)
    if not given or not given[0].any():
        return exchange.routed(iter(()))
    flag, owners, levels = given
    of_key, level_of = np.full(len(keys), _NONE), np.zeros(len(keys), np.uint8)
    of_key[flag], level_of[flag] = owners, levels
    place = np.searchsorted(keys, windows.hashes)
    owner, level, mine = of_key[place], level_of[place], windows.ids[windows.row]
    passages, claims = {}, {}
    seen: dict[tuple[int, int, bytes], int] = {}
    homes: dict[tuple[int, int], list[int]] = {}
    for member, ours in ((owner == mine, True), (owner < mine, False)):
        for a, b in zip(*(x.tolist() for x in _runs(member, windows, owner, level)), strict=True):
            raw, who = _text(windows.words, windows.starts[a], windows.starts[b] + size - 1), int(owner[a])
            deep = min(int(level[a]), (4 * shards).bit_length())  # more cells than that reach no further shard
            if (who, deep) not in homes:
                homes[who, deep] = _shards(who, deep, np.arange(1 << deep), shards)
            home = homes[who, deep]
            if ours:
                for shard in dict.fromkeys(home):
                    passages.setdefault(shard, {})[who, raw] = None
            else:
                shard = home[zlib.crc32(raw, block) % len(home)] if deep else home[0]
                row = windows.row[a]
                at = int(windows.starts[a] - windows.words.offsets[row])
                held = claims.setdefault(shard, ([], []))
                number = seen.get((shard, who, raw))
                if number is None:
                    number = seen[shard, who, raw] = len(held[0])
                    held[0].append((who, raw))
                held[1].append((number, int(row), at))

    def rows() -> Iterator[tuple[int, int, bytes]]:
        for shard in sorted({*passages, *claims}):
            own, (told, places) = list(passages.get(shard, ())), claims.get(shard, ([], []))
            found = np.array(places, dtype="<u4").reshape(-1, 3)
            yield shard, block, blobs.pack(*_texts(own), *_texts(told), found[:, 0], found[:, 1], found[:, 2])

    return exchange.routed(rows())


def _texts(pairs: list[tuple[int, bytes]]) -> list[np.ndarray]:
    sizes = np.array([len(r) for _, r in pairs], dtype="<u4")
    return [np.array([o for o, _ in pairs], np.int64), sizes, np.frombuffer(b"".join(r for _, r in pairs), np.uint8)]


def _pieces(sizes: np.ndarray, raw: np.ndarray) -> Iterator[bytes]:
    ends = np.cumsum(sizes.astype(np.int64)).tolist()
    whole = raw.tobytes()
    for size, end in zip(sizes.tolist(), ends, strict=True):
        yield whole[end - size : end]


class Automaton:
    """Aho-Corasick over word sequences of one length, each with its smallest owner.

    Every word of a passage is a number, and a number is one character (two,
    where there are more words than characters), so that the patterns and what
    is streamed through them are strings. Number 0 is any other word."""

    def __init__(self, size: int, characters: int = 0x10FFFF - 0x800):
        import ahocorasick

        self.size, self.characters, self.width = size, characters, 1
        self.numbers: dict[bytes, int] = {}
        self.passages: list[tuple[list[int], int]] = []
        self.tree = ahocorasick.Automaton()

    def add(self, passage: list[bytes], owner: int) -> None:
        numbers = self.numbers
        self.passages.append(([numbers.setdefault(w, len(numbers) + 1) for w in passage], owner))

    def compile(self) -> None:
        self.width = 1 if len(self.numbers) <= self.characters else 2
        owners: dict[str, int] = {}
        for ids, owner in self.passages:
            text, step = self._string(ids), self.width
            for i in range(0, (len(ids) - self.size + 1) * step, step):
                key = text[i : i + self.size * step]
                if owners.setdefault(key, owner) > owner:
                    owners[key] = owner
        self.passages = []
        for key, owner in owners.items():
            self.tree.add_word(key, owner)
        if owners:
            self.tree.make_automaton()

    def _string(self, ids: list[int]) -> str:
        code = np.array(ids, dtype="<u4")
        if self.width == 1:
            code[code >= 0xD800] += 0x800  # surrogates are no characters of their own
        else:
            code = np.stack([code >> 15, code & 0x7FFF], axis=1)
        return code.tobytes().decode("utf-32-le")

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first word, ascending, and owners of all occurrences."""
        if not len(self.tree):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = self._string(list(map(self.numbers.get, words, repeat(0))))
        found = np.fromiter(chain.from_iterable(self.tree.iter(text)), dtype=np.int64).reshape(-1, 2)
        start = found[:, 0] + 1 - self.size * self.width
        whole = start % self.width == 0
        return start[whole] // self.width, found[whole, 1]


def _spans(automaton: Automaton, owners: np.ndarray, texts: Iterator[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (text, first word, number of words) of the texts that windows of
    their owner cover. All texts are streamed as one, with
    a word that no passage holds between them."""
    words: list[bytes] = []
    bounds = []
    for text in texts:
        bounds.append(len(words))
        words += text
        words.append(b" ")
    begins = np.array(bounds, dtype=np.int64)
    start, who = automaton.find(words)
    text = np.searchsorted(begins, start, side="right") - 1
    ours = who == owners[text]
    start, text = start[ours], text[ours]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > start[:-1] + automaton.size)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1 if len(first) else first
    return text[first], start[first] - begins[text[first]], start[last] + automaton.size - start[first]


def _confirm(table: pa.Table, size: int) -> pa.Table:
    """Confirmed spans of a shard's claims. Owners are dealt to automata of about
    ``AUTOMATON`` bytes of passages, built one after the other: a claim needs
    only the passages of its owner, and small ones are fast and soon freed."""
    messages = [blobs.unpack(d.as_py()) for d in table.column("data")]
    groups = 1 + sum(len(m[2]) for m in messages) // AUTOMATON
    dealt = lambda owners: (mix(owners.view(np.uint64)) % U64(groups)).astype(np.int64)
    held = [(dealt(m[0]), m[0], list(_pieces(*m[1:3]))) for m in messages]
    told = [(dealt(m[3]), m[3], list(_pieces(*m[4:6]))) for m in messages]
    found: list[list[tuple[np.ndarray, ...]]] = [[] for _ in messages]
    for group in range(groups):
        automaton = Automaton(size)
        for home, owners, texts in held:
            for k in np.flatnonzero(home == group).tolist():
                automaton.add(texts[k].split(b" "), int(owners[k]))
        automaton.compile()
        for spans, (home, owners, texts) in zip(found, told, strict=True):
            mine = np.flatnonzero(home == group)
            text, start, length = _spans(automaton, owners[mine], (texts[k].split(b" ") for k in mine.tolist()))
            spans.append((mine[text], start, length))
    shard, rows = table.column("shard")[0].as_py(), []
    for block, message, spans in zip(table.column("block").to_pylist(), messages, found, strict=True):
        text, start, length = (np.concatenate(x) for x in zip(*spans, strict=True))
        order = np.argsort(text, kind="stable")
        start, length = start[order], length[order]
        number, row, at = message[6:]
        many = np.bincount(text, minlength=len(message[3]))
        n = many[number]
        if n.sum():
            # the spans of a claim's text, once for every place that the claim stands at
            before = (np.cumsum(many) - many)[number] - (np.cumsum(n) - n)
            every = np.repeat(before, n) + np.arange(int(n.sum()))
            place = start[every] + np.repeat(at.astype(np.int64), n)
            rows.append((block, shard, blobs.pack(np.repeat(row, n), place.astype("<u4"), length[every].astype("<u4"))))
    return exchange.answered(rows)


def _cut(table: pa.Table, spans: pa.Table) -> pa.Table:
    table = exchange.ordered(table)
    parts = [blobs.unpack(d.as_py()) for d in spans.column("data")]
    row, at, n = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, int),) * 3
    by_row: dict[int, list[tuple[int, int]]] = {}
    for r, a, k in zip(row.tolist(), at.tolist(), n.tolist(), strict=True):
        by_row.setdefault(r, []).append((a, a + k))
    total, gone, kept = [], [], []
    for r, text in enumerate(table.column("text")):
        words = text.as_py().encode().split()
        total.append(len(words))
        left = words
        if r in by_row:
            keep = np.ones(len(words), dtype=bool)
            for a, b in by_row[r]:
                keep[a:b] = False
            left = [words[k] for k in np.flatnonzero(keep).tolist()]
        gone.append(len(words) - len(left))
        kept.append(b" ".join(left).decode())
    cols = [table.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
    return pa.Table.from_arrays(cols, names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated_phrases(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept (the words
    left, parted by single spaces).

    Windows are judged on the input. Null and empty texts have no words; texts
    shorter than a window lose nothing; a null doc_id counts as smaller than
    any other; rows with equal doc_id never remove words from each other; an
    empty table gives no rows; other columns are ignored.
    """
    blocked, _ = exchange.blocks(docs)
    shards = partitions(docs.sparkSession)

    def keys(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        found, *values = Windows(exchange.ordered(table), size).distinct()
        return found, values

    owners = exchange.ask(blocked, keys, _owners, shards)
    sent = exchange.finish(blocked, {"owners": owners}, lambda t, r: _claims(t, r["owners"], size, shards), exchange.ROUTED)
    spans = sent.repartition(shards, "shard").groupBy("shard").applyInArrow(lambda t: _confirm(t, size), exchange.ANSWER)
    return exchange.finish(blocked, {"spans": spans}, lambda t, r: _cut(t, r["spans"]), RESULT)
