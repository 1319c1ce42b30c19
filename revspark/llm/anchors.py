"""Anchors: each window of a text names one place inside it, by its content alone.

A window of ``LENGTH`` bytes takes the place x of the smallest hash among its pieces of ``T``
bytes, and x modulo W is the place of its anchor, a string of ``K`` = LENGTH - W + 1 bytes (the
mod-minimizer). Equal windows have equal anchors at equal places, so strings of LENGTH bytes that
repeat meet wherever texts are dealt out by their anchors; neighbouring windows mostly share an
anchor, so about one place in W is one.
"""

from __future__ import annotations

import numpy as np

from revspark.llm.common import BYTE_VALUES, U64, inverse_powers, mix, powers

LENGTH = 50
K = 31
W = LENGTH - K + 1
T = 4 + (K - 4) % W
PLACE_BITS = 24


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span`` takes the hashes of spans from them."""
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=sums[1:])
    return sums


def span(sums: np.ndarray, starts: np.ndarray, size) -> np.ndarray:
    """64-bit hash of the bytes [start, start + size) for each start."""
    with np.errstate(over="ignore"):
        return mix((sums[starts + size] - sums[starts]) * inverse_powers(len(sums))[starts])


def rolling(sums: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` bytes, good enough to order them by."""
    n = len(sums) - size
    with np.errstate(over="ignore"):
        out = sums[size:] - sums[:-size]
        out *= inverse_powers(n)
        out ^= out >> U64(32)
        out *= U64(0xC2B2AE3D27D4EB4F)
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def window_anchors(sums: np.ndarray) -> np.ndarray:
    """The anchor's place for every window of a text (fewer than 2**24 bytes), given its running
    sums."""
    n = len(sums) - LENGTH
    if n <= 0:
        return np.zeros(0, np.int64)
    marked = rolling(sums, T)
    low = U64((1 << PLACE_BITS) - 1)
    # The place in the low bits: of equal hashes the leftmost is the smallest.
    marked &= ~low
    marked |= np.arange(len(marked), dtype=np.uint64)
    least = (sliding_minimum(marked, LENGTH - T + 1) & low).astype(np.int32)
    windows = np.arange(n, dtype=np.int32)
    return windows + (least - windows) % np.int32(W)


def _segments(data: np.ndarray, offs: np.ndarray):
    sums = prefix_sums(data)
    anchors = window_anchors(sums)
    if not len(anchors):
        return tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)
    # Windows of one row only: those that begin early enough in it.
    inside = np.zeros(len(anchors) + 1, np.int32)
    last = np.maximum(offs[1:] - LENGTH + 1, offs[:-1])
    np.add.at(inside, np.minimum(offs[:-1], len(anchors)), 1)
    np.add.at(inside, np.minimum(last, len(anchors)), -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= (anchors[1:] != anchors[:-1]) | ~inside[:-1]
    begins = offs[:-1][(offs[:-1] < len(anchors))]
    new[begins] |= inside[begins]
    first = np.flatnonzero(new)
    # A segment ends where the next one or a gap begins.
    gap = np.flatnonzero(~inside & np.append(False, inside[:-1]))
    stops = np.sort(np.concatenate([first, gap, [len(anchors)]]))
    stop = stops[np.searchsorted(stops, first, side="right")]
    at, counts = anchors[first].astype(np.int64), stop - first
    rows = np.searchsorted(offs, first, side="right") - 1
    kmers = span(sums, at, K)
    whole = span(sums, first, counts + LENGTH - 1)
    with np.errstate(over="ignore"):
        keys = mix(whole + counts.astype(np.uint64) * U64(W + 1) + (at - first).astype(np.uint64))
    return rows, first, counts, at - first, kmers, keys


def segments(data: np.ndarray, offs: np.ndarray, block: int = 1 << 18):
    """Maximal runs of neighbouring windows of one row with one anchor, in order: row, place of
    the first window in ``data``, number of windows, the anchor's offset from that place, the
    anchor's 64-bit hash, and a 64-bit hash of the whole segment (its text, windows and offset).

    Works through blocks of rows of about ``block`` bytes, and long rows in overlapping pieces,
    so that intermediate arrays stay in the cache; a segment may be cut at a piece's edge.
    """
    out = []
    row, n = 0, len(offs) - 1
    while row < n:
        end = int(np.searchsorted(offs, offs[row] + block, side="right")) - 1
        end = min(n, max(end, row + 1))
        base, stop = int(offs[row]), int(offs[end])
        for start in range(base, max(stop - LENGTH + 1, base + 1), 4 * block):
            piece = min(stop, start + 4 * block + LENGTH - 1)
            local = np.clip(offs[row:end + 1], start, piece) - start
            found = _segments(data[start:piece], local)
            out.append((found[0] + row, found[1] + start, *found[2:]))
        row = end
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)
    return tuple(np.concatenate(x) for x in zip(*out))
