"""Operator 4 against a plain version with the same boundaries; shift resistance; edges."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marquee.llm import blobs, exchange, queries
from marquee.llm import line_chunks as lc
from marquee.llm.textnp import U64, buffer, mix, span_hashes
from tests.llm.data import SCHEMA, awkward, real


def line_hash(line: str) -> int:
    data, offsets = buffer(pa.array([line]))
    return int(span_hashes(data, offsets[:-1], offsets[1:])[0])


def chunks(text: str) -> list[tuple[int, int]]:
    """(first, last line) of every chunk: for each function, windows of two
    lines with text open or close one; the last opening meets the first closing."""
    lines = text.split("\n")
    ink = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\f\r")]
    hashes, out = [line_hash(lines[k]) for k in ink], set()
    rolls = [h * lc._FACTOR + g for h, g in zip(hashes, hashes[1:], strict=False)]
    for seed in range(lc.SEEDS):
        opened = None
        seeded = np.array([(x + (seed + 1) * lc._FACTOR) % 2**64 for x in rolls], np.uint64)
        for a, b, bits in zip(ink, ink[1:], mix(seeded).tolist(), strict=False):
            if bits & 1:
                opened = a
            if bits & 2 and opened is not None:
                out.add((opened, b))
                opened = None
    return sorted(out)


def brute(docs):
    """doc_id -> (lines left, lines, lines gone); the first by (doc_id, text, place) stays."""
    first, out = {}, {}
    for d, text in sorted(docs, key=lambda x: (x[0], x[1] or "")):
        lines, gone = (text or "").split("\n"), set()
        for a, b in chunks(text or ""):
            holder, end = first.setdefault("\n".join(lines[a : b + 1]), ((d, a), b))
            if holder != (d, a) and (holder[0] != d or a > end):
                gone.update(range(a, b + 1))
        out[d] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)
    return out


def check(spark, docs):
    got = lc.remove_repeated_chunks(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == brute(docs)
    return sum(r.n_removed for r in got)


def test_documents(spark):
    assert check(spark, real())


def test_awkward(spark):
    assert check(spark, awkward())


def test_boundaries_resist_shifts():
    lines = [f"line number {k}" for k in range(200)]
    cut = lambda x: {"\n".join(x[a : b + 1]) for a, b in chunks("\n".join(x))}
    whole, shifted = cut(lines), cut(["put", "in", "front", *lines[:90], "new", *lines[90:]])
    lost = [c for c in whole if c not in shifted]
    assert all("line number 89\nline number 90" in c for c in lost)


def by_hand(docs):
    """The operator's steps without Spark, a block for each document."""
    tables = [pa.table({"block": pa.array([k], pa.int32()), "doc_id": [d], "text": [t]}) for k, (d, t) in enumerate(docs)]
    asked = [lc._keys(t) for t in tables]
    codes = lc._owners([k for k, _ in asked], [v for _, v in asked], list(range(len(docs))))
    packed = [exchange.answered([(k, 0, blobs.pack(*c))]) for k, c in enumerate(codes)]
    claims = pa.concat_tables([lc._claim(t, c, 1) for t, c in zip(tables, packed, strict=True)])
    equal = lc._compare(claims)
    back = [equal.filter(pc.equal(equal["block"], k)) for k in range(len(docs))]
    rows = [lc._cut(t, c, e).to_pylist()[0] for t, c, e in zip(tables, packed, back, strict=True)]
    return {r["doc_id"]: r["n_removed"] for r in rows}


def test_unequal_bytes_are_kept(monkeypatch):
    """With a hash that takes every chunk for the same, only equal bytes go."""
    monkeypatch.setattr(lc, "boundaries", lambda h, row, seeds: (np.array([0]), np.array([1])))
    docs = [(k, f"first {k // 3}\nsecond {k // 3}") for k in range(6)]
    assert by_hand(docs) == {0: 0, 1: 2, 2: 2, 3: 0, 4: 2, 5: 2}
    monkeypatch.setattr(lc.Chunks, "_hashes", lambda self: np.full(len(self.first_line), U64(1 << 40)))
    assert by_hand(docs) == {0: 0, 1: 2, 2: 2, 3: 0, 4: 0, 5: 0}


def test_edges(spark):
    assert lc.remove_repeated_chunks(spark.createDataFrame([], SCHEMA)).collect() == []
    text = "\n".join(f"words of line {k}" for k in range(30))
    docs = spark.createDataFrame([(1, text, "p"), (1, text, "q"), (None, text, "r"), (2, None, "s")], SCHEMA + ", x0 string")
    got = lc.remove_repeated_chunks(docs, ("x0",)).collect()
    assert sorted(r.x0 for r in got) == ["p", "q", "r", "s"]
    by = {r.x0: r for r in got}
    assert by["r"].n_removed == 0 and by["p"].n_removed > 0 and by["q"].n_removed > 0
    assert (by["s"].text, by["s"].n_lines) == ("", 1)


def repeated_runs(docs):
    """doc_id -> (lines left, lines, lines gone): every run of two or more lines
    with text that stands earlier, by (doc_id, place), is gone."""
    seen, out = {}, {}
    for d, text in sorted(docs):
        lines = (text or "").split("\n")
        ink = [k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\f\r")]
        gone = set()
        for a, b in zip(ink, ink[1:], strict=False):
            key = "\n".join(lines[a : b + 1])
            # a first occurrence does not lose its own second line
            if seen.setdefault(key, (d, a, b)) != (d, a, b) and seen[key] != (d, a - (b - a), a):
                gone.update(range(a, b + 1))
        out[d] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)
    return out


def test_recall_of_repeated_runs(spark):
    """Of the lines in repeated runs, wherever they begin, over nine tenths go,
    and no line outside one."""
    r = random.Random(12)
    shared = [[f"passage {p} line {k}" for k in range(r.choice([2, 2, 3, 4, 8]))] for p in range(60)]
    made = []
    for d in range(300):
        lines = [f"own {d} {k}" for k in range(6)]
        for p in r.sample(shared, 2):
            at = r.randrange(len(lines) + 1)
            lines[at:at] = p
        made.append((d, "\n".join(lines)))
    for docs in (made, real()):
        got = lc.remove_repeated_chunks(spark.createDataFrame(docs, SCHEMA)).collect()
        want = {d: n for d, (_, _, n) in repeated_runs(docs).items()}
        assert all(x.n_removed <= want[x.doc_id] for x in got)
        assert sum(x.n_removed for x in got) >= 0.9 * sum(want.values()) > 0


def test_lines_that_repeat_at_once(spark):
    check(spark, [(1, "x\nx"), (2, "a\nx\nx\nx\nx\nb"), (3, "a\n\nx"), (4, "a\n\nx\nc"), (5, "\n".join(["y", "z"] * 30))])


def test_query_finds_short_runs_in_any_context(spark, tmp_path):
    """Headers of two lines below a line of their own: no boundary before them is shared."""
    docs = [(k, f"title {k}\nfirst line of the header\nsecond line of the header\nbody {k}") for k in range(40)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_removed for r in queries.op4_line_chunks(spark, str(tmp_path)).collect()}
    assert got == {k: 2 if k else 0 for k in range(40)}


def lines_of(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return "\n".join(" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=12)) for _ in range(n))


def test_runs_of_texts_do_not_matter(monkeypatch):
    texts = pa.chunked_array([["", lines_of(30, 1), " \n\n \t", "one line", lines_of(3, 2) + "\n", lines_of(30, 1), "ä\n\nö\nü"]])
    names = ["line_starts", "line_ends", "line_row", "first_line", "last_line", "row", "hashes"]
    whole = lc.Chunks(texts)
    monkeypatch.setattr(lc, "runs", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    single = lc.Chunks(texts)
    for name in names:
        assert getattr(whole, name).tolist() == getattr(single, name).tolist(), name
    assert len(lc.Chunks(pa.chunked_array([], pa.string())).hashes) == 0


def test_chunks_need_little_more_than_the_texts():
    texts = pa.chunked_array([[lines_of(120, k) for k in range(800)]])
    lc.Chunks(texts.slice(0, 1))  # its tables stay
    tracemalloc.start()
    chunks = lc.Chunks(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(chunks.data) > 6_000_000 and peak < 10 * len(chunks.data)  # 18 times the texts before
