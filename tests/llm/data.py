"""Small tables with the awkward cases, and the sf0.001 documents."""

from __future__ import annotations

import random

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def real(n: int | None = None) -> list[tuple[int, str]]:
    rows = pq.read_table(f"{SF}/documents.parquet")
    return list(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), strict=True))[:n]


def items() -> list[tuple[int, str]]:
    rows = pq.read_table(f"{SF}/benchmark.parquet")
    return list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True))


def awkward(seed: int = 3) -> list[tuple[int, str | None]]:
    """Null, empty and very long texts, odd white space, copies, near copies
    and shared passages; distinct ids that do not start at 0."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6)))
    base = [word() for _ in range(120)]
    shared = " ".join(word() for _ in range(60))
    rows: list[tuple[int, str | None]] = [(10, None), (11, ""), (12, " \t\n "), (13, "one"), (14, "one"), (15, "a b c d")]
    rows += [(20 + k, " ".join(base)) for k in range(4)]
    for k in range(12):
        near = list(base)
        for _ in range(r.randint(1, 6)):
            near[r.randrange(len(near))] = word()
        rows.append((40 + k, (" " if k % 2 else "\n").join(near)))
    for k in range(8):
        own = [word() for _ in range(30)]
        rows.append((60 + k, " ".join(own[:15]) + "\r\n" + shared + "\x0b" + " ".join(own[15:])))
    rows.append((80, " ".join(["same", "words", "again", "and", "again"] * 40)))
    rows.append((81, "\n".join(["line one here", "", "line two here", "line one here"] * 10)))
    rows.append((82, " ".join(word() for _ in range(20_000))))
    rows.append((83, "x" * 200_000))
    rows.append((-5, "Mixed CASE Text É with # $ % and | pipes " * 3))
    r.shuffle(rows)
    return rows
