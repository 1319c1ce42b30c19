"""Tokens and their byte ends for whole texts, from two kinds of tokenizer.

A text's bytes are taken with a space before them. Both tokenizers work on units that they treat
apart: a byte-level BPE file (tokenizers) on the pieces of its splitting rule, a sentencepiece BPE
model on a run of spaces with the run of other characters behind it, as none of its entries has a
space behind another character. A worker asks the library for each distinct unit once and keeps its
ids and spans; a text's tokens are gathered from its units' with numpy.

Spans of a unit: the tokenizers library's character offsets, and the begin and end bytes of
sentencepiece's proto, are coarse cuts. Tokens that part a character share its cut, and byte-fallback
tokens have an empty span but for the last: these are refined with the bytes that the tokens' entries
decode to. Whether all tokens' bytes joined are the unit's own is kept too.
"""

from __future__ import annotations

import os

import numpy as np

from revspark.llm.common import BYTE_VALUES, kept, span_hashes
from revspark.llm.piece_table import PieceTable
from revspark.llm.pretoken import Classes, split

MAX_UNITS = 1 << 20  # units a worker remembers of each tokenizer; others are asked for again
MAX_UNIT_BYTES = 256  # of a remembered unit
MAX_HELD_TOKENS = 1 << 23  # of all remembered units
SPACE_MARK = "▁"  # sentencepiece's sign for a space


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters are themselves, the other bytes in order are the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Tokens:
    """Ids of all texts in one array, each token's bytes, and per text: the number of tokens and
    whether their bytes are the text's own."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray, whole: np.ndarray):
        self.ids, self.sizes, self.counts, self.whole = ids, sizes, counts, whole


class _Units:
    """What is known of units: ids and byte sizes of their tokens, and if these are whole."""

    def __init__(self) -> None:
        self.table = PieceTable(MAX_UNITS)
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int32)
        self.start = np.zeros(MAX_UNITS, np.int64)
        self.count = np.zeros(MAX_UNITS, np.int32)
        self.good = np.zeros(MAX_UNITS, bool)

    def tokens(self, hashes: np.ndarray, lengths: np.ndarray, ask) -> tuple:
        """(ids, sizes) of all units' tokens, their number and wholeness by unit. ``ask(places)``
        gives (ids, sizes, counts, good) of units at these places from the library."""
        at = self.table.get(hashes)
        start, count = self.start[at], self.count[at].astype(np.int64)
        good = self.good[at]
        missing = np.flatnonzero(at < 0)
        pool, sizes = self.ids, self.sizes
        if len(missing):
            _, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            places = missing[first]
            ids, own, counts, whole = ask(places)
            starts = np.cumsum(counts) - counts
            short = lengths[places] <= MAX_UNIT_BYTES
            # Those that are remembered go in front, so that their tokens can be appended as they are.
            order = np.argsort(~short, kind="stable")
            take = _ranges(starts[order], counts[order])
            ids, own, places = ids[take], own[take], places[order]
            counts, whole = counts[order], whole[order]
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            starts = np.cumsum(counts) - counts
            size = self.table.size
            room = len(self.ids) + np.cumsum(counts[:int(short.sum())]) <= MAX_HELD_TOKENS
            n = self.table.add(hashes[places[:int(room.sum())]])
            self.start[size:size + n] = len(self.ids) + starts[:n]
            self.count[size:size + n] = counts[:n]
            self.good[size:size + n] = whole[:n]
            pool, sizes = np.concatenate([pool, ids]), np.concatenate([sizes, own])
            start[missing] = len(self.ids) + starts[rank[back]]
            count[missing], good[missing] = counts[rank[back]], whole[rank[back]]
            held = len(self.ids) + int(counts[:n].sum())
            self.ids, self.sizes = pool[:held].copy(), sizes[:held].copy()
        take = _ranges(start, count)
        return pool[take], sizes[take], count, good


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after the other."""
    stops = np.cumsum(counts)
    total = int(stops[-1]) if len(stops) else 0
    return np.repeat(starts - (stops - counts), counts) + np.arange(total)


def _by_text(values: np.ndarray, per_text: np.ndarray, how) -> np.ndarray:
    """``how`` (a ufunc) over the units of each text; its identity for a text without units."""
    out = np.full(len(per_text), how.identity, values.dtype)
    filled = np.flatnonzero(per_text)
    if len(filled):
        starts = (np.cumsum(per_text) - per_text)[filled]
        out[filled] = how.reduceat(values, starts)
    return out


class _Spelling:
    """The bytes that a vocabulary's entries decode to."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(entries), np.uint8)

    def whole(self, ids: np.ndarray, counts: np.ndarray, units: list[bytes]) -> np.ndarray:
        """Whether each unit's tokens, ``counts`` of them, spell it."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        spelt = np.add.reduceat(np.append(self.sizes[ids], 0), np.cumsum(counts) - counts)
        spelt = np.where(counts > 0, spelt, 0)
        good = spelt == lengths
        own = np.repeat(good, counts)
        found = self.pool[_ranges(self.starts[ids[own]], self.sizes[ids[own]])]
        asked = np.frombuffer(b"".join([u for u, ok in zip(units, good.tolist()) if ok]), np.uint8)
        wrong = np.flatnonzero(found != asked)
        stops = np.cumsum(lengths[good])
        good[np.flatnonzero(good)[np.searchsorted(stops, wrong, side="right")]] = False
        return good


def refined(cuts: np.ndarray, coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Token sizes from the cuts at the ends of tokens. Where a cut isn't the token's own end (not
    ``coarse``), the token ends as many bytes behind the one before it as its entry has."""
    spelt = np.cumsum(sizes)
    at = np.arange(len(cuts))
    known = np.maximum.accumulate(np.where(coarse, at, -1))
    stops = np.where(known >= 0, cuts[known] - spelt[known], 0) + spelt
    return np.diff(stops, prepend=0)


class ByteLevel:
    """A byte-level BPE file, special strings taken as text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.classes = Classes(self.library.pre_tokenizer)
        alphabet = byte_level_alphabet()
        vocabulary = self.library.get_vocab()
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)  # not so: a special token's own string
            entries[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.spelling = _Spelling(entries)
        self.units = _Units()

    def _ask(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and byte sizes of all units' tokens, their number, and whether they are whole."""
        out = []
        for a in range(0, len(units), 4096):
            some = units[a:a + 4096]
            found = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids, unit = np.array(found.ids, np.int32), np.array(found.word_ids, np.int64)
            counts = np.bincount(unit, minlength=len(some))
            spans = np.array(found.offsets, np.int64).reshape(-1, 2)  # characters of the unit
            raw = [u.encode() for u in some]
            points = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
            widths = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            until = np.concatenate([[0], np.cumsum(widths)])  # bytes before each character
            first = np.cumsum([0, *map(len, some[:-1])])
            end = first[unit] + spans[:, 1]
            # A token whose last character the next token has bytes of ends inside that character.
            shared = np.zeros(len(ids), bool)
            shared[:-1] = (unit[1:] == unit[:-1]) & (spans[1:, 0] < spans[:-1, 1])
            sizes = refined(until[end], ~shared, self.spelling.sizes[ids])
            out.append((ids, sizes.astype(np.int32), counts,
                        self.spelling.whole(ids, counts, raw)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def __call__(self, texts: list[str]) -> Tokens:
        whole, starts, ends, hashes, per_text = split(texts, self.classes)

        def ask(places: np.ndarray):
            pairs = zip(starts[places].tolist(), ends[places].tolist())
            return self._ask([whole[a:b] for a, b in pairs])

        ids, sizes, count, good = self.units.tokens(hashes, (ends - starts) * 4, ask)
        return Tokens(ids, sizes, _by_text(count, per_text, np.add),
                      _by_text(good, per_text, np.logical_and))


class SentencePiece:
    """A sentencepiece model; it puts a space before each text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.fallback = np.array([self.library.is_byte(i) for i in range(n)])
        self.spelling = _Spelling([
            bytes([int(p[3:5], 16)]) if self.fallback[i] else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)])
        self.space = self.library.piece_to_id(SPACE_MARK)
        # Units are encoded apart only if no entry goes across their border.
        self.apart = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.units = _Units()

    def _together(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and byte sizes of the tokens of units that are one text, and the tokens' number by
        unit. Each begins with a space, the first one's being the one that the library adds."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        text = b"".join(units)
        if text == b" ":  # the library gives an empty text nothing at all
            return np.array([self.space], np.int32), np.ones(1, np.int64), np.ones(1, np.int64)
        found = self.library.encode(text[1:].decode(), return_type="proto").pieces
        table = np.array([(p.id, p.begin, p.end) for p in found], np.int64).reshape(-1, 3)
        ids, cuts = table[:, 0].astype(np.int32), table[:, 2] + 1  # of the text with its space
        # Byte-fallback tokens have the span of their character at the last one, and the space that
        # is added to the text has none.
        coarse = ~self.fallback[ids] & (table[:, 2] > table[:, 1])
        sizes = refined(cuts, coarse, self.spelling.sizes[ids])
        owner = np.searchsorted(np.cumsum(lengths), np.cumsum(sizes))
        return ids, sizes, np.bincount(np.minimum(owner, len(units) - 1), minlength=len(units))

    def _ask(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``ByteLevel._ask``. Thousands of units make one text, as their tokens don't depend on
        what is before or behind them; those that end with a space would, and go alone."""
        mark = SPACE_MARK.encode()
        alone = np.array([not self.apart or u.endswith(b" ") or mark in u for u in units], bool)
        runs = [[i] for i in np.flatnonzero(alone).tolist()]
        others = np.flatnonzero(~alone).tolist()
        runs += [others[a:a + 4096] for a in range(0, len(others), 4096)]
        found = []
        for run in runs:
            own = [units[i] for i in run]
            ids, sizes, counts = self._together(own)
            found.append((ids, sizes.astype(np.int32), counts, self.spelling.whole(ids, counts, own)))
        ids, sizes, counts, good = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(np.concatenate(runs))  # back to the order in which they were asked for
        take = _ranges((np.cumsum(counts) - counts)[order], counts[order])
        return ids[take], sizes[take], counts[order], good[order]

    def __call__(self, texts: list[str]) -> Tokens:
        """``texts``: with the space before them."""
        rows = [t.encode() for t in texts]
        whole = b"".join(rows)
        data = np.frombuffer(whole, np.uint8)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        offs = np.concatenate([[0], np.cumsum(lengths)])
        starts = np.zeros(len(data), bool)
        if self.apart:
            space = data == 0x20
            starts[1:] = space[1:] & ~space[:-1]
            for i in [i for i, t in enumerate(texts) if SPACE_MARK in t]:
                starts[offs[i]:offs[i + 1]] = False  # the sign itself is taken as a space
        starts[offs[:-1][lengths > 0]] = True
        starts = np.flatnonzero(starts)
        ends = np.append(starts[1:], len(data))[:len(starts)]
        per_text = np.diff(np.searchsorted(starts, offs))

        def ask(places: np.ndarray):
            pairs = zip(starts[places].tolist(), ends[places].tolist())
            return self._ask([whole[a:b] for a, b in pairs])

        hashes = span_hashes(BYTE_VALUES[data], starts, ends)
        ids, sizes, count, good = self.units.tokens(hashes, ends - starts, ask)
        return Tokens(ids, sizes, _by_text(count, per_text, np.add),
                      _by_text(good, per_text, np.logical_and))


def tokenizer_pair(byte_level: str, sentence_piece: str) -> tuple[ByteLevel, SentencePiece]:
    """The worker's encoders for two public tokenizer files."""
    import public_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return kept(("spans", byte_level, sentence_piece), lambda: (
        ByteLevel(public_tokenizers.path(byte_level)),
        SentencePiece(public_tokenizers.path(sentence_piece))))
