"""Numpy arrays as compact byte strings, for rows that travel between tasks.

Each array is cut into byte planes (all first bytes, all second bytes, ...),
after differencing if it ascends, and the planes are compressed together.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_KINDS = ["u1", "<u2", "<u4", "<u8", "<i4", "<i8", "<f4", "<f8", "|b1"]
_CODE = {np.dtype(k): i for i, k in enumerate(_KINDS)}


def pack(*arrays: np.ndarray, ascending: tuple[int, ...] = ()) -> bytes:
    """Arrays (one-dimensional) as one byte string; ``ascending`` names the
    places of those that never fall, which are stored as differences."""
    out = []
    squeeze = zstandard.ZstdCompressor(level=1)
    for k, a in enumerate(arrays):
        a = np.ascontiguousarray(a)
        code = _CODE[a.dtype]
        if k in ascending and len(a):
            a = np.concatenate([a[:1], np.diff(a)])
        width = a.dtype.itemsize
        planes = a.view(np.uint8).reshape(-1, width).T
        used = max((j + 1 for j in range(width) if planes[j].any()), default=0) if len(a) else 0
        body = squeeze.compress(np.ascontiguousarray(planes[:used]).tobytes()) if used else b""
        out.append(struct.pack("<BBBIQ", code, k in ascending, used, len(body), len(a)))
        out.append(body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``, in order."""
    found, at, view = [], 0, memoryview(data)
    while at < len(view):
        code, ascending, used, size, n = struct.unpack_from("<BBBIQ", view, at)
        at += struct.calcsize("<BBBIQ")
        kind = np.dtype(_KINDS[code])
        planes = np.zeros((kind.itemsize, n), dtype=np.uint8)
        if used:
            raw = zstandard.ZstdDecompressor().decompress(view[at : at + size], max_output_size=used * n)
            planes[:used] = np.frombuffer(raw, np.uint8).reshape(used, n)
        at += size
        a = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        found.append(np.cumsum(a, dtype=kind) if ascending and n else a)
    return found
