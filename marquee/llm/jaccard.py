"""N-gram Jaccard join with adaptive multi-match prefixes (operator 9).

A document is the set of its distinct word shingles. Sets of sizes n and m with
Jaccard similarity of at least 4/5 share at least 4(n + m)/9 >= 4n/5 shingles,
so with all shingles in one global order (rarest first) the first
n - ceil(4n/5) + l of both share at least l. Each document picks its own l by
the estimated cost of its prefix: a longer prefix meets more postings, but asks
more matches of a pair before it is verified. A pair asks k = min(l, l')
matches of prefixes cut to its own sizes: the first n - ceil(4(n + m)/9) + k and
m - ceil(4(n + m)/9) + k. Shingles of a single document are never posted, which
is exact.

1. Equal sets form classes; one representative goes on.
2. Document frequencies: blocks ask hash shards (``exchange``).
3. Representatives post their prefixes; those with any posting write their set.
4. Star round: on each shingle every document is verified against the first
   one only. Groups of near copies fall into one component at a cost linear in
   the postings.
5. Multi-match round: pairs of different components with enough shared prefix
   shingles are verified. They meet on (shingle, size band): the smaller one
   posts to its own band, with a prefix for partners of at least its size (a
   ninth of its shingles), the larger one to each band that a partner may have.
   Components meet first, by the furthest any of their documents reaches, then
   documents. Pairs inside a component need no check, since only components are
   asked for.

Shingles are 64-bit hashes; a pair is verified on the upper 48 bits of its two
sets. Nothing is collected, and nothing grows with the square of a group of
copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import blobs, exchange
from marquee.llm.common import partitions, written
from marquee.llm.components import components
from marquee.llm.textnp import U64, Words, buffer, gram_hashes, joined, mix, runs
from marquee.operators.skew import heavy_keys, hot_key_join

SHINGLE = 5
VERIFY_COST = 0.125  # of the verifications a posting may lead to: one costs 16, one in 128 stands the pair's own prefix
BAND = 1.12  # ratio of sizes within a band
TOKEN_BITS = 40  # of a shingle hash, for frequencies: shared leading bits only add to them
SETS_PER_TASK = 1024  # sets that one document is verified against in one task
SPLIT_KEYS = 1024  # documents whose verifications are dealt to several tasks: any other has under 1 / 1024 of them
OUT = "kind int, doc_id long, rid long, other long, n int, l int, own int, pos int, data binary"
_OUT = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("other", pa.int64()), ("n", pa.int32()), ("l", pa.int32()), ("own", pa.int32()), ("pos", pa.int32()), ("data", pa.binary())])
_DOC, _POST, _SET = 0, 1, 2


def least_overlap(n: int) -> int:
    """Shingles a set of n must share with any set linked to it."""
    return (4 * n + 4) // 5


def linked(shared: int, n: int, m: int) -> bool:
    return 100 * shared >= 80 * (n + m - shared)


def shingle_sets(texts: pa.ChunkedArray, size: int = SHINGLE) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    column, sets = joined(texts), []
    for first, end in runs(buffer(column)[1]):
        words = Words(column.slice(first, end - first), lower=True)
        h = words.hashes()
        grams = gram_hashes(h, size)
        for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
            n = b - a
            sets.append(np.unique(grams[a : b - size + 1]) if n >= size else gram_hashes(h[a:b], n) if n else np.zeros(0, np.uint64))
    return sets


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit digests of each set, as columns."""
    out = np.zeros((len(sets), 2), dtype=np.uint64)
    for k, s in enumerate(sets):
        out[k, 0] = np.add.reduce(mix(s ^ U64(0x5851F42D4C957F2D))) + U64(len(s))
        out[k, 1] = np.add.reduce(mix(s + U64(0x14057B7EF767814F)))
    return mix(out)


class _Block:
    """A block's rows in order: ids, sets, and the first row of every distinct set."""

    def __init__(self, table: pa.Table):
        table = exchange.ordered(table)
        self.number = exchange.block_of(table)
        self.doc_ids = table.column("doc_id")
        self.sets = shingle_sets(table.column("text"))
        self.rids = (np.int64(self.number) << np.int64(32)) + np.arange(len(self.sets))
        self.digests = _digests(self.sets)
        rows = np.flatnonzero([len(s) > 0 for s in self.sets])
        self.keys, first, back = np.unique(self.digests[rows, 0], return_index=True, return_inverse=True)
        self.rows, self.first, self.back = rows, rows[first], back

    def classes(self, table: pa.Table) -> np.ndarray:
        """Every row's representative (its own rid where it is one)."""
        rep, given = self.rids.copy(), exchange.answers(table)
        if given:
            same = self.digests[self.rows, 1] == self.digests[self.first, 1][self.back]
            rep[self.rows[same]] = given[0][self.back[same]]
        return rep


def _classes(keys: list[np.ndarray], values: list[list[np.ndarray]], blocks: list[int]) -> list[list[np.ndarray]]:
    """The representative of each set: its row of smallest (doc_id, rid)."""
    every, second, ids, rids = (np.concatenate(x) for x in (keys, *([v[j] for v in values] for j in range(3))))
    order = np.lexsort((rids, ids, second, every))
    a, b = every[order], second[order]
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    rep = np.empty(len(every), dtype=np.int64)
    rep[order] = rids[order][first][np.cumsum(first) - 1]
    return [[r] for r in np.split(rep, np.cumsum([len(k) for k in keys])[:-1])]


def _frequencies(keys: list[np.ndarray], values: list[list[np.ndarray]], blocks: list[int]) -> list[list[np.ndarray]]:
    every, n = np.concatenate(keys), np.concatenate([v[0] for v in values])
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    total = np.empty(len(every), dtype="<u4")
    total[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(ranked))))
    return [[t] for t in np.split(total, np.cumsum([len(k) for k in keys])[:-1])]


def choose_prefix(df: np.ndarray, n: int) -> tuple[int, int]:
    """(l, prefix length) of least estimated cost, for frequencies in order.

    Postings met are sum(df - 1) over the prefix; no more than that over l
    documents can meet l times, and each of those costs a verification."""
    base = n - least_overlap(n)
    met = np.cumsum(df - 1.0)[base:]
    ell = 1 + int(np.argmin(met * (1.0 + VERIFY_COST / np.arange(1, len(met) + 1))))
    return ell, base + ell


def _tokens(block: _Block, own: np.ndarray) -> np.ndarray:
    """The tokens of these rows' sets, one after the other."""
    every = np.concatenate([block.sets[r] for r in own])
    every >>= U64(64 - TOKEN_BITS)
    return every


def _firsts(ranked: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))


def _spread(block: _Block, own: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Aligned with ``_tokens``: each token's value, from those of the ascending distinct ones."""
    tokens = _tokens(block, own)
    order = np.argsort(tokens)
    first = _firsts(tokens[order])
    out = np.empty(len(tokens), values.dtype)
    out[order] = np.repeat(values, np.diff(first, append=len(tokens)))
    return out


def _frequency_keys(table: pa.Table, replies: dict[str, pa.Table], shards: int) -> pa.Table:
    block = _Block(table)
    own = np.flatnonzero((block.classes(replies["classes"]) == block.rids) & [len(s) > 0 for s in block.sets])
    if not len(own):
        return exchange.routed(iter(()))
    tokens = _tokens(block, own)
    tokens.sort()
    first = _firsts(tokens)
    n = np.diff(first, append=len(tokens)).astype("<u4")
    return exchange.send(block.number, tokens[first] << U64(64 - TOKEN_BITS), [n], shards, TOKEN_BITS)


def _postings(table: pa.Table, replies: dict[str, pa.Table]) -> pa.Table:
    """A row for each document, posting and set of the block (see OUT)."""
    block = _Block(table)
    rep = block.classes(replies["classes"])
    ids = block.doc_ids.to_pylist()
    rows = [(_DOC, i, r, c, len(s), 0, 0, 0, None) for i, r, c, s in zip(ids, block.rids.tolist(), rep.tolist(), block.sets, strict=True)]
    own = np.flatnonzero((rep == block.rids) & [len(s) > 0 for s in block.sets])
    if len(own):
        df, at = _spread(block, own, exchange.answers(replies["df"])[0]), 0
        for r in own.tolist():
            s = block.sets[r]
            own_df, at = df[at : at + len(s)], at + len(s)
            order = np.argsort(own_df, kind="stable")  # sets ascend, so ties go by hash
            ell, length = choose_prefix(own_df[order].astype(np.float64), len(s))
            posted = [(place, k) for place, k in enumerate(order[:length].tolist()) if own_df[k] > 1]
            rid = int(block.rids[r])
            own_only = int(np.sum(own_df == 1))
            rows += [(_POST, None, rid, int(s[k].astype(np.int64)), len(s), ell, own_only, place, None) for place, k in posted]
            if posted:
                rows.append((_SET, None, rid, None, len(s), 0, own_only, 0, blobs.pack(s >> U64(16), ascending=(0,))))
    cols = list(zip(*rows, strict=True)) or [[]] * len(_OUT)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _OUT.types, strict=True)], schema=_OUT)


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones of the pairs (a, b). A document that meets very many
    others is dealt to as many tasks as their count asks for, its own set copied
    to each."""
    hot = F.broadcast(heavy_keys(pairs, "a", SETS_PER_TASK, SPLIT_KEYS))
    salt = F.pmod(F.xxhash64("b"), F.coalesce("__parts", F.lit(1))).cast("int")
    dealt = pairs.join(hot, F.col("a") == F.col("__hot"), "left").select("a", "b", salt.alias("salt"))
    right = hot_key_join(dealt, sets, "b", "rid", columns=["data"], rename={"data": "other"}, spread_by=["a"])
    right = right.select(F.col("a").alias("to"), F.col("salt").alias("part"), "b", "other")
    left = dealt.select("a", "salt").distinct().join(sets.select(F.col("rid").alias("a"), "data"), "a")

    def run(one: pa.Table, many: pa.Table) -> pa.Table:
        found: list[int] = []
        if one.num_rows and many.num_rows:
            mine = blobs.unpack(one.column("data")[0].as_py())[0]
            for b, data in zip(many.column("b").to_pylist(), many.column("other"), strict=True):
                other = blobs.unpack(data.as_py())[0]
                if linked(len(np.intersect1d(mine, other, assume_unique=True)), len(mine), len(other)):
                    found.append(b)
        a = one.column("a")[0].as_py() if one.num_rows else 0
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return left.groupBy("a", "salt").cogroup(right.groupBy("to", "part")).applyInArrow(run, "a long, b long")


def _possible(n: str, own_n: str, m: str, own_m: str) -> F.Column:
    """Sizes that allow a similarity of 4/5: shingles that no other document has
    are never shared, so at most min(n - own, m - own) are."""
    return F.least(F.col(n) - F.col(own_n), F.col(m) - F.col(own_m)) * 9 >= (F.col(n) + F.col(m)) * 4


def _band(n: F.Column) -> F.Column:
    return F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")


def _banded(posts: DataFrame) -> DataFrame:
    """The postings on (token, band) that a pair of two components may meet on.

    ``reach`` is the size of the largest partner that a posting is in the prefix
    for, times four: pos < n - ceil(4(n + m)/9) + l. ``home`` rows are for
    partners of at least the document's size; such a document has at most a
    ninth of its shingles to itself."""
    posts = posts.withColumn("reach", 5 * F.col("n") - 9 * (F.col("pos") + 1 - F.col("l")))
    least = F.ceil(F.col("n") * 4 / 5)
    rows = posts.select("*", F.explode(F.sequence(_band(least), _band(F.col("n")))).alias("band"))
    from_size = F.floor(F.pow(F.lit(BAND), "band") * (1 - 1e-9))  # no size of the band is below it
    rows = rows.where(F.col("reach") >= 4 * F.greatest(least, from_size))
    home = (F.col("band") == _band(F.col("n"))) & (F.col("reach") >= 4 * F.col("n")) & (F.col("own") * 9 <= F.col("n"))
    rows = rows.withColumn("home", home)
    mixed = rows.groupBy("token", "band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("home").alias("z"))
    return rows.join(mixed.where("x <> y and z").select("token", "band"), ["token", "band"], "left_semi")


def _met(rows: DataFrame) -> DataFrame:
    """(a, b, asked) for each shared shingle within the prefixes of a pair of
    different components; ``asked`` is how many of them it must have."""
    own = F.struct("rid", "n", "own", "l", "reach")
    homes = rows.where("home").groupBy("token", "band", F.col("component").alias("c"))
    homes = homes.agg(F.max("reach").alias("c_reach"), F.min("n").alias("c_least"))
    visits = rows.groupBy("token", "band", F.col("component").alias("d"))
    visits = visits.agg(F.max("reach").alias("d_reach"), F.min("n").alias("d_least"), F.max("n").alias("d_most"))
    across = homes.join(visits, ["token", "band"])
    across = across.where("c <> d and c_reach >= 4 * greatest(c_least, d_least) and d_reach >= 4 * c_least and d_most >= c_least")
    one = rows.where("home").select("token", "band", F.col("component").alias("c"), own.alias("p"))
    two = rows.select("token", "band", F.col("component").alias("d"), own.alias("q"))
    met = across.join(one, ["token", "band", "c"])
    met = met.where("p.reach >= 4 * d_least and d_reach >= 4 * p.n and d_most >= p.n").join(two, ["token", "band", "d"])
    asked = F.least("p.l", "q.l")
    met = met.where(
        ((F.col("p.n") < F.col("q.n")) | ((F.col("p.n") == F.col("q.n")) & (F.col("p.rid") < F.col("q.rid"))))
        & (F.col("p.reach") - 9 * (F.col("p.l") - asked) >= 4 * F.col("q.n"))
        & (F.col("q.reach") - 9 * (F.col("q.l") - asked) >= 4 * F.col("p.n"))
        & _possible("p.n", "p.own", "q.n", "q.own")
    )
    return met.select(F.col("p.rid").alias("a"), F.col("q.rid").alias("b"), asked.alias("asked"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles, class_id (smallest doc_id
    with the same shingles), component_id (smallest doc_id reachable by links).

    Null and empty texts have no shingles and stand alone; texts of fewer words
    than a shingle are one shingle; rows with a null doc_id take part but never
    name a class or component that has another row (else it is null); repeated
    rows are copies; an empty table gives no rows; other columns are ignored.
    """
    blocked, _ = exchange.blocks(docs)
    shards = partitions(docs.sparkSession)

    def class_keys(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        block = _Block(table)
        ids = block.doc_ids.fill_null((1 << 62)).to_numpy()
        return block.keys, [block.digests[block.first, 1], ids[block.first], block.rids[block.first]]

    classes = exchange.ask(blocked, class_keys, _classes, shards)
    sent = exchange.finish(blocked, {"classes": classes}, lambda t, r: _frequency_keys(t, r, shards), exchange.ROUTED)
    df = exchange.reply(sent, _frequencies, shards)
    found = written(exchange.finish(blocked, {"classes": classes, "df": df}, _postings, OUT), "jaccard")
    rows = found.where(F.col("kind") == _DOC).select("doc_id", "rid", F.col("other").alias("rep"), F.col("n").alias("n_shingles"))
    posts = found.where(F.col("kind") == _POST).select(F.col("other").alias("token"), "rid", "n", "l", "own", "pos")
    sets = found.where(F.col("kind") == _SET).select("rid", "data")

    # star round: everyone against the document of each posted shingle that has
    # the fewest shingles of its own, the likeliest centre of a group of copies
    heads = posts.groupBy("token").agg(F.min(F.struct("own", "rid", "n")).alias("h"), F.count("*").alias("f")).where("f > 1")
    star = hot_key_join(posts, heads, "token", "token", columns=["h"], spread_by=["rid"])
    star = star.where(F.col("rid") != F.col("h.rid")).select(
        F.col("h.rid").alias("a"), F.col("rid").alias("b"), F.col("h.n").alias("m"), F.col("h.own").alias("own_m"), "n", "own"
    )
    star = star.where(_possible("m", "own_m", "n", "own")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    star = written(star.distinct(), "star")
    links = written(_verify(star, sets), "links")
    label = written(components(links), "labels")

    # multi-match round: only between components
    named = posts.join(label.withColumnRenamed("node", "rid"), "rid", "left")
    met = _met(written(_banded(named.withColumn("component", F.coalesce("component", "rid"))), "banded"))
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("asked").alias("asked"))
    pairs = pairs.where("shared >= asked").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.join(star, ["a", "b"], "left_anti"), "pairs")
    more = written(_verify(pairs, sets), "links")
    every = links.unionByName(more)
    rows = hot_key_join(rows, components(every), "rep", "node", "left", ["component"], spread_by=["rid"])
    rows = written(rows.withColumn("component", F.coalesce("component", "rep")), "rows")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    first = rows.groupBy("rep").agg(F.min("doc_id").alias("class_id"))
    rows = hot_key_join(rows, least, "component", "component", columns=["component_id"], spread_by=["rid"])
    return hot_key_join(rows, first, "rep", "rep", columns=["class_id"], spread_by=["rid"]).select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "class_id", "component_id"
    )


def one_per_component(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of their component, all columns
    kept. Rows equal in doc_id are one document; rows without a doc_id cannot be
    named and stay."""
    gone = jaccard_components(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
