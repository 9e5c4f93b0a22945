"""Cross-tokenizer alignment (operator 13).

A text in two tokenizations is two ascending lists of byte offsets where tokens
end. The shorter list drives an exponential-plus-binary (galloping) search into
the longer; offsets found in both cut the tokens into groups, and the ranks the
search returns say which tokens of the other side each token overlaps.

Both tokenizers start anew at a space between words, so a text is cut into
units there; each distinct unit of a chunk of texts is encoded and aligned
once, all units of a chunk in one vectorised search. A unit whose bytes do not
come back makes every text that holds it one without tokens, as the whole text
would. Texts in which a cut could fall inside a run of white space are cut only
after other characters, and a text without a safe cut is one unit.

How many documents hold an id pair: each chunk sends its distinct pairs with its
own counts as rows, which Spark sums, and gets them back with the sums. A chunk
is bounded by the bytes of its texts, and a pair that every document holds is
one row per chunk.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import blobs
from marquee.llm.bpe import byte_alphabet
from marquee.llm.common import quiet_threads, written

CHUNK_BYTES = 8 << 20
_UNITS_KEPT = 150_000
CHUNK = "chunk long, blob binary, doc_ids array<long>, sha array<string>, pairs array<long>, held array<long>"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_UNSAFE = re.compile(r"  |\s (?=\s|\Z)").search
_CUT = re.compile(r"(?<=\S)(?= )").split


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in ``long`` (ascending) that
    holds as much or more, at or after ``start``: steps double until they pass
    the value, then halve. All values take each step together."""
    n, low = len(long), start.astype(np.int64)
    padded = np.append(long, np.iinfo(np.int64).max)
    going, high = np.flatnonzero(padded[low] < short), low.copy()
    step = 1
    while len(going):  # long[low] is below the value; look `step` further
        high[going] = np.minimum(low[going] + step, n)
        below = padded[high[going]] < short[going]
        going = going[below]
        low[going] = high[going]
        step *= 2
    open_ = np.flatnonzero(high > low)
    low[open_] += 1
    while len(open_):
        mid = (low[open_] + high[open_]) // 2
        below = padded[mid] < short[open_]
        low[open_] = np.where(below, mid + 1, low[open_])
        high[open_] = np.where(below, high[open_], mid)
        open_ = open_[low[open_] < high[open_]]
    return low


def align(a_ends: np.ndarray, b_ends: np.ndarray, a_start: np.ndarray, b_start: np.ndarray):
    """(places in a, places in b) of the common ends, and (a, b) of every
    overlapping pair of tokens. ``a_start[i]`` is a place in b at or before the
    first token that overlaps token i of a, and ``b_start`` likewise."""
    if len(b_ends) < len(a_ends):
        b_common, a_common, b, a = align(b_ends, a_ends, b_start, a_start)
        return a_common, b_common, a, b
    rank = gallop(a_ends, b_ends, a_start)  # ends of b before each end of a
    common = rank < len(b_ends)
    common[common] = b_ends[rank[common]] == a_ends[common]
    after = np.concatenate([[0], (rank + common)[:-1]])  # ends of b up to the end before: the first token that overlaps
    links = rank - after + 1
    a = np.repeat(np.arange(len(a_ends)), links)
    b = np.arange(int(links.sum())) - np.repeat(np.cumsum(links) - links - after, links)
    return np.flatnonzero(common), rank[common], a, b


def byte_level(path: str):
    """(encode, bytes of each id) of a byte-level BPE file of the tokenizers
    library whose merges are in the order of their ids, encoded as ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    back = {c: b for b, c in byte_alphabet().items()}
    known = {t: k for t, k in model["vocab"].items() if all(c in back for c in t)}
    merged = [known["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    special = {t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]}
    ranks = {bytes(back[c] for c in t): k for t, k in known.items() if t not in special}
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    enc = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for raw, k in ranks.items():
        table[k] = raw
    return enc.encode_ordinary, table


def pieces(path: str):
    """(encode, bytes of each id) of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(k) for k in range(sp.vocab_size())]
    if any("▁" in name.lstrip("▁") for name in names):
        raise ValueError(f"{path}: a piece reaches over a space")
    table = [bytes([int(n[3:5], 16)]) if sp.is_byte(k) else n.replace("▁", " ").encode() for k, n in enumerate(names)]
    return lambda text: sp.encode(text, num_threads=1), table


class Aligner:
    """Both tokenizers, and the units seen of late with all that is known of them."""

    def __init__(self, a_path: str, b_path: str):
        quiet_threads()
        self.a, self.a_bytes = byte_level(a_path)
        self.b, self.b_bytes = pieces(b_path)
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        # one written form per id and what follows it
        self.shown = [f"{k}{c}".encode() for t, c in ((self.a_bytes, ","), (self.a_bytes, "|"), (self.b_bytes, ","), (self.b_bytes, ";")) for k in range(len(t))]
        self.b_space = self.b("x ")[len(self.b("x")) :]  # a space between others; alone the library doubles it
        self.clear()

    def clear(self) -> None:
        self.units = _Units()
        self.form: list[bytes] = []  # the groups of each unit as written, b"" if its bytes do not come back
        self.facts = np.zeros((0, 4), dtype=np.int64)  # n_a, n_b, n_groups, whether its bytes come back
        self.link_at = np.zeros(1, dtype=np.int64)  # links of unit u: link_at[u] to link_at[u + 1]
        self.links = np.zeros(0, dtype=np.int64)  # a << 32 | b of every link

    def take(self, texts: list[str]) -> list[np.ndarray]:
        """The units of each text; what is new among them is encoded and aligned."""
        if len(self.units) > _UNITS_KEPT:
            self.clear()
        look, found = self.units.__getitem__, []
        for text in texts:
            if _UNSAFE(" " + text):
                parts = [p[1:] for p in _CUT(" " + text)]
            else:
                parts = text.split(" ")
            found.append(np.fromiter(map(look, parts), dtype=np.int64, count=len(parts)))
        self._learn()
        return found

    def _learn(self) -> None:
        new, self.units.new = self.units.new, []
        if not new:
            return
        a, b = [self.a(" " + u) for u in new], [self.b(u) if u else self.b_space for u in new]
        n_a, n_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (a, b))
        a_ids, b_ids = (np.array([k for x in y for k in x], dtype=np.int64) for y in (a, b))
        good = self._come_back(new, a, b)
        n_a, a_ids = np.where(good, n_a, 0), a_ids[np.repeat(good, n_a)]
        n_b, b_ids = np.where(good, n_b, 0), b_ids[np.repeat(good, n_b)]
        a_at, b_at = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        ac, bc, la, lb = align(a_end, b_end, np.repeat(b_at, n_a), np.repeat(a_at, n_b))
        unit = np.repeat(np.arange(len(new)), n_a)
        groups = np.bincount(unit[ac], minlength=len(new))
        self.form += self._written(a_ids, b_ids, ac, bc, n_a + n_b)
        self.facts = np.concatenate([self.facts, np.column_stack([n_a, n_b, groups, good.astype(np.int64)])])
        n_links = np.bincount(unit[la], minlength=len(new))
        self.link_at = np.concatenate([self.link_at, self.link_at[-1] + np.cumsum(n_links)])
        self.links = np.concatenate([self.links, a_ids[la] << 32 | b_ids[lb]])

    def _come_back(self, new: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether the bytes of both tokenizations are those of each unit."""
        a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        raw = [b" " + u.encode() for u in new]
        return np.array([b"".join(map(a_of, x)) == r == b"".join(map(b_of, y)) for r, x, y in zip(raw, a, b, strict=True)], dtype=bool)

    def _written(self, a_ids, b_ids, ac, bc, n_tokens) -> list[bytes]:
        """``a1,a2|b1;`` for every group, joined by unit."""
        na, nb = len(self.a_bytes), len(self.b_bytes)
        a_code, b_code = a_ids.copy(), b_ids + 2 * na
        a_code[ac] += na
        b_code[bc] += nb
        # a token stands behind all tokens of earlier groups, and a's before b's
        a_group = np.searchsorted(ac, np.arange(len(a_ids)))
        b_group = np.searchsorted(bc, np.arange(len(b_ids)))
        a_before, b_before = np.concatenate([[-1], bc]) + 1, ac + 1
        codes = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        codes[np.arange(len(a_ids)) + a_before[a_group]] = a_code
        codes[np.arange(len(b_ids)) + b_before[b_group]] = b_code
        shown = list(map(self.shown.__getitem__, codes.tolist()))
        at = np.concatenate([[0], np.cumsum(n_tokens)]).tolist()
        return [b"".join(shown[x:y]) for x, y in zip(at, at[1:], strict=False)]


class _Units(dict):
    """Unit -> its number; new ones are numbered and remembered as they are met."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker; its units are bounded."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def spread(at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``at[w]:at[w + 1]`` of every w in ``which`` one after another, and
    the place in ``which`` of each."""
    n = at[which + 1] - at[which]
    first = np.repeat(at[which] - (np.cumsum(n) - n), n)
    return first + np.arange(len(first)), np.repeat(np.arange(len(which)), n)


def _chunk(al: Aligner, number: int, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
    """One row: the documents' units, the units' links, and the chunk's distinct
    pairs with how many of its documents hold each."""
    found = al.take(texts)
    n_units = np.array(list(map(len, found)), dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), n_units)
    every = np.concatenate(found) if found else np.zeros(0, np.int64)
    good = np.ones(len(texts), dtype=bool)
    np.logical_and.at(good, doc[al.facts[every, 3] == 0], False)
    good &= np.array([t != "" for t in texts], dtype=bool)
    join, sha256 = b"".join, hashlib.sha256
    sha = [sha256(join([al.form[u] for u in x.tolist()])[:-1]).hexdigest() if ok else "" for x, ok in zip(found, good.tolist(), strict=True)]
    every, doc = every[good[doc]], doc[good[doc]]
    used, local = np.unique(every, return_inverse=True)
    key, times = np.unique(doc * len(used) + local, return_counts=True)
    doc, local = (key // len(used), key % len(used)) if len(used) else (key, key)
    places, _ = spread(al.link_at, used)
    pairs, link = np.unique(al.links[places], return_inverse=True)
    n_links = al.link_at[used + 1] - al.link_at[used]
    link_at = np.concatenate([[0], np.cumsum(n_links)])
    # documents per pair: the distinct (document, pair) of the chunk
    rows, entry = spread(link_at, local)
    held = doc[entry] * max(1, len(pairs)) + link[rows]
    held.sort()
    held = held[np.concatenate([[True], held[1:] != held[:-1]])] if len(held) else held
    count = np.bincount(held % max(1, len(pairs)), minlength=len(pairs)).astype(np.int64)
    per_doc = np.searchsorted(doc, np.arange(len(texts) + 1)).astype("<i8")
    facts = al.facts[used].astype("<i4")
    step = np.diff(local, prepend=0)  # ascending within a document, so mostly small
    blob = blobs.pack(per_doc, step.astype("<i4"), times.astype("<i4"), n_links.astype("<i4"), link.astype("<i4"), facts[:, 0], facts[:, 1], facts[:, 2], ascending=(0,))
    cols = [[number], [blob], [doc_ids], [sha], [pairs], [count]]
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["chunk", "blob", "doc_ids", "sha", "pairs", "held"])


def _chunks(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    al, part, n = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            ids.append(doc_id)
            texts.append(text)
            size += len(text) + 1
            if size >= chunk_bytes:
                yield _chunk(al, part << 32 | n, ids, texts)
                ids, texts, size, n = [], [], 0, n + 1
    if ids:
        yield _chunk(al, part << 32 | n, ids, texts)


def _finished(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one chunk, with the corpus-wide counts of its pairs."""
    blob, doc_ids, sha = (left.column(c)[0] for c in ("blob", "doc_ids", "sha"))
    per_doc, step, times, n_links, link, n_a, n_b, n_groups = (x.astype(np.int64) for x in blobs.unpack(blob.as_py()))
    order = np.argsort(right.column("i").to_numpy(), kind="stable")
    count = right.column("n").to_numpy()[order]
    best = right.column("best").to_numpy(zero_copy_only=False)[order]
    link_at = np.concatenate([[0], np.cumsum(n_links)])

    def by_unit(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values[link])])
        return total[link_at[1:]] - total[link_at[:-1]]

    local = np.cumsum(step)
    units = [n_a, n_b, n_groups, n_links, by_unit(best.astype(np.int64)), by_unit(count.astype(np.int64))]
    cols = []
    for values in units:
        total = np.concatenate([[0], np.cumsum(values[local] * times)])
        cols.append(pa.array(total[per_doc[1:]] - total[per_doc[:-1]]))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.Table.from_arrays([doc_ids.values, *cols, sha.values], names=names)


def chunked(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The aligned documents, one row per chunk, as a table."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return written(rows.mapInArrow(lambda it: _chunks(it, a_path, b_path, chunk_bytes), CHUNK), "aligned")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair ``a << 32 | b``, and whether
    no pair of the same a has more. The highest count of each a, at most one
    row per id of tokenizer A, is what is broadcast."""
    rows = chunks.select(F.explode(F.arrays_zip("pairs", "held")).alias("r")).select("r.pairs", "r.held")
    counts = written(rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n")), "pair-counts")
    a = F.shiftright("pair", 32).alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("top"))
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 of both tokenizations of its text behind a space.

    Null and empty texts, and texts whose bytes either tokenizer does not give
    back, have no tokens: zeros and ''. Null and repeated doc_ids are documents
    like any other, and each row counts as one document of its pairs. An empty
    table gives no rows. Columns besides doc_id and text are left behind.
    """
    chunks = chunked(docs, a_path, b_path, chunk_bytes)
    asked = chunks.select("chunk", F.posexplode("pairs").alias("i", "pair"))
    told = asked.join(pair_counts(chunks), "pair").select(F.col("chunk").alias("of"), "i", "n", "best")
    held = chunks.select("chunk", "blob", "doc_ids", "sha")
    return held.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(_finished, ALIGNED)
