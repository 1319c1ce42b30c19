"""Numpy arrays packed into compact binary rows for shuffles.

Sorted 64-bit hashes are the bulk of what inverted lists move. Held as differences, with the bytes
of equal weight together, their high bytes vanish under a fast compressor.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*arrays: np.ndarray, ascending: int = 0, level: int = 1) -> bytes:
    """Integer arrays in one blob; the first ``ascending`` ones are sorted."""
    heads, bodies = [], []
    for k, a in enumerate(arrays):
        a = np.ascontiguousarray(a)
        if k < ascending and len(a):
            a = np.concatenate([a[:1], np.diff(a)])
        heads.append(f"{a.dtype.str}:{len(a)}:{int(k < ascending)}")
        bodies.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    head = ";".join(heads).encode()
    packer = zstandard.ZstdCompressor(level=level)
    return packer.compress(struct.pack("<I", len(head)) + head + b"".join(bodies))


def unpack(blob) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size = struct.unpack_from("<I", raw)[0]
    at, out = 4 + size, []
    for field in raw[4:at].decode().split(";"):
        kind, n, ascending = field.split(":")
        dtype, n = np.dtype(kind), int(n)
        body = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at)
        a = np.ascontiguousarray(body.reshape(dtype.itemsize, n).T).view(dtype).reshape(n)
        out.append(np.cumsum(a, dtype=dtype) if ascending == "1" else a)
        at += n * dtype.itemsize
    return out
