"""Words of many texts at once, in numpy over Arrow's UTF-8 buffers.

A word hash is a polynomial over a random byte table, taken from one prefix sum
per slice of the buffer, then mixed. Hashes decide routing and candidates; an
operator that must be exact compares the words themselves afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPAN = 1 << 20  # bytes hashed at a time, which bounds the working memory
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_STEP = U64(0xD1342543DE82EF97)

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (in place where it can)."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def joined(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.string())
    return column


def runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about _SPAN bytes together (a longer one alone), as
    (first, end): arrays with a number for every byte or word of a run stay
    small, whatever the block holds."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _SPAN, side="right")) - 1)
        yield a, b
        a = b


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; the offsets start at 0."""
    column = joined(column)
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of the texts: ``starts``/``ends`` in ``data`` (byte positions),
    ``offsets[d]:offsets[d+1]`` are the words of text d."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = False):
        self.data, self.text_offsets = buffer(column)
        if lower:
            self.data = LOWER[self.data]
        n = len(self.data)
        inside = ~SPACES[self.data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        final = inside.copy()
        final[:-1] &= ~inside[1:]
        edges = self.text_offsets[(self.text_offsets > 0) & (self.text_offsets < n)]
        begin[edges] = inside[edges]  # a text's end ends its last word
        final[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(final) + 1
        self.offsets = np.searchsorted(self.starts, self.text_offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()

    def doc_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[starts:ends]; spans ascend and may not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        base = starts[k]
        stop = max(k + 1, int(np.searchsorted(ends, base + _SPAN, side="right")))
        a, b = starts[k:stop] - base, ends[k:stop] - base
        size = int(b[-1])
        power, inverse = _powers(size)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[base : base + size]] * power[:size], out=total[1:])
        h = (total[b] - total[a]) * inverse[a]
        out[k:stop] = mix(h + (b - a).astype(np.uint64) * _STEP)
        k = stop
    return out


_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if size > _SPAN:  # one very long word: not kept
        return _run(_P, size), _run(_P_INV, size)
    if "span" not in _POWERS:
        _POWERS["span"] = _run(_P, _SPAN), _run(_P_INV, _SPAN)
    return _POWERS["span"]


def _run(factor: int, size: int) -> np.ndarray:
    steps = np.full(size, U64(factor))
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place on (len - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h *= U64(0xA0761D6478BD642F)
        h += words[j : j + n]
    return mix(h + U64(k * int(_STEP) % (1 << 64)))


def gram_starts(offsets: np.ndarray, k: int) -> np.ndarray:
    """Word positions at which k words of one text begin, ascending."""
    n = np.maximum(np.diff(offsets) - (k - 1), 0)
    first = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return first + np.arange(int(n.sum()))
