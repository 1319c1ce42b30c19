"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour; the leftmost S
ones (LMS) of each run are sorted first and all others are induced from them, one pass up and one
down through the buckets of first characters. A bucket's known suffixes induce their left
neighbours all at once; those that fall into the same bucket form the next wave, so a pass takes
as many array operations as there are buckets and runs of equal characters. LMS substrings are
sorted by such a pass and named; if names repeat, the string of names is sorted in its turn, by
doubling of ranks, up to the depth that is asked for.
"""

from __future__ import annotations

import numpy as np

from revspark.llm.common import BYTE_VALUES, span_hashes


def classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(S type, LMS positions); the end of the text counts as the smallest character of all."""
    n = len(text)
    new = np.ones(n, bool)
    new[1:] = text[1:] != text[:-1]
    first = np.flatnonzero(new)
    char = text[first]
    smaller = np.zeros(len(first), bool)  # than the next run; the last run is larger than the end
    smaller[:-1] = char[:-1] < char[1:]
    s_type = np.repeat(smaller, np.diff(np.append(first, n)))
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    return s_type, lms


class _Buckets:
    """Suffixes put behind each other in the buckets of their first characters."""

    def __init__(self):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(256)]

    def add(self, suffixes: np.ndarray, chars: np.ndarray) -> None:
        if not len(suffixes):
            return
        order = np.argsort(chars, kind="stable")
        suffixes, chars = suffixes[order], chars[order]
        cuts = np.flatnonzero(np.diff(chars)) + 1
        for part, first in zip(np.split(suffixes, cuts), chars[np.append(0, cuts)].tolist()):
            self.parts[first].append(part)

    def take(self, char: int) -> np.ndarray:
        parts = self.parts[char]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def induce(text: np.ndarray, s_type: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from LMS suffixes in order."""
    n = len(text)
    l_buckets, s_buckets, lms_buckets = _Buckets(), _Buckets(), _Buckets()
    lms_buckets.add(lms, text[lms])

    def left(wave: np.ndarray, want_s: bool) -> tuple[np.ndarray, np.ndarray]:
        before = wave[wave > 0] - 1
        before = before[s_type[before] == want_s]
        return before, text[before]

    def spread(wave: np.ndarray, char: int, want_s: bool, buckets: _Buckets) -> np.ndarray:
        """Put what ``wave`` induces into other buckets; returns the same bucket's next wave."""
        before, chars = left(wave, want_s)
        same = chars == char
        buckets.add(before[~same], chars[~same])
        return before[same]

    chars = np.flatnonzero(np.bincount(text, minlength=256)).tolist()
    if n:  # the end, smallest of all, induces the last suffix
        l_buckets.add(np.array([n - 1]), text[-1:])
    for char in chars:
        wave = l_buckets.take(char)
        while len(wave):
            wave = spread(wave, char, False, l_buckets)
            if len(wave):
                l_buckets.parts[char].append(wave)
        spread(lms_buckets.take(char), char, False, l_buckets)
    for char in reversed(chars):
        wave = s_buckets.take(char)
        while len(wave):
            wave = spread(wave, char, True, s_buckets)
            if len(wave):
                s_buckets.parts[char].append(wave)
        wave = l_buckets.take(char)[::-1]
        spread(wave, char, True, s_buckets)
    out = []
    for char in chars:
        out += [l_buckets.take(char), s_buckets.take(char)[::-1]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def sort_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a string of names in the order of their first ``depth`` names at least."""
    ranks, reach = names.astype(np.int64) + 1, 1
    m = len(ranks)
    while reach < depth and len(ranks) and ranks.max() < m:
        behind = np.zeros(m, np.int64)
        behind[: max(0, m - reach)] = ranks[reach:]
        _, ranks = np.unique(ranks * (ranks.max() + 1) + behind, return_inverse=True)
        ranks = ranks + 1
        reach *= 2
    return np.argsort(ranks, kind="stable")


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes of a byte string in the order of their first ``depth`` bytes (None: in full)."""
    if not len(text):
        return np.zeros(0, np.int64)
    depth = len(text) if depth is None else depth
    s_type, lms = classify(text)
    if len(lms) > 1:
        # LMS substrings in order: a pass from LMS positions in any order.
        ordered = induce(text, s_type, lms)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        ordered = ordered[is_lms[ordered]]
        stop = np.append(lms[1:] + 1, len(text))
        number = np.zeros(len(text), np.int64)
        number[lms] = np.arange(len(lms))
        hashes = span_hashes(BYTE_VALUES[text], lms, stop)
        hashes[-1] ^= np.uint64(1)  # the last one ends with the text's end, like no other
        own, sizes = hashes[number[ordered]], (stop - lms)[number[ordered]]
        new = np.zeros(len(lms), np.int64)
        new[1:] = (own[1:] != own[:-1]) | (sizes[1:] != sizes[:-1])
        names = np.empty(len(lms), np.int64)
        names[number[ordered]] = np.cumsum(new)
        # LMS positions are two bytes apart at least.
        lms = lms[sort_names(names, depth // 2 + 2)]
    return induce(text, s_type, lms)


def permuted_prefixes(text: np.ndarray, suffixes: np.ndarray, length: int
                      ) -> tuple[np.ndarray, np.ndarray]:
    """Permuted common prefixes cut at ``length``: in the order of the text, the places of all
    suffixes but the first, and whether each has ``length`` bytes in common with its predecessor
    in the order of suffixes.

    If the suffix one byte before has the predecessor one byte before, its common prefix less one
    carries on, so one more byte is compared; others are compared eight bytes at a time. All
    suffixes must have ``length`` bytes (8 at least)."""
    raw = np.ascontiguousarray(text)
    words = np.ndarray((max(0, len(raw) - 7),), "<u8", raw, 0, (1,))
    before = np.full(len(raw), -1, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    places = np.flatnonzero(before >= 0)
    before = before[places]
    carried = np.zeros(len(places), bool)
    carried[1:] = (np.diff(places) == 1) & (np.diff(before) == 1)
    same = raw[places + length - 1] == raw[before + length - 1]
    first = np.flatnonzero(~carried)
    a, b, whole = places[first], before[first], np.ones(len(first), bool)
    for at in [*range(0, length - 7, 8), length - 8]:
        whole &= words[a + at] == words[b + at]
    same[first] = whole
    # A carried prefix is long enough if nothing differed since the last one compared in full.
    number = np.arange(len(places))
    differs = np.maximum.accumulate(np.where(same, -1, number))
    return places, differs < np.maximum.accumulate(np.where(carried, 0, number))


def common_prefix_at_least(text: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """For each of the suffixes but the first, whether it has ``length`` bytes in common with the
    one before it, by permuted common prefixes."""
    places, same = permuted_prefixes(text, suffixes, length)
    at = np.zeros(len(text), bool)
    at[places] = same
    return at[suffixes[1:]]
