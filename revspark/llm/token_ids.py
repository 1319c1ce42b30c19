"""Token ids of whole texts by the tokenizers library, with a worker's memory of pieces.

Both file kinds encode the pieces of a text independently: byte-level files split it by
``pretoken``, word files drop white space, so the text's white-space separated words are pieces,
without the stops behind them, and in lower case if the file has no other.
The library encodes each piece when a worker first meets it; the ids of a text are gathered from
the pieces' ids with numpy. A text that holds a special string goes to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from revspark.llm.common import BYTE_VALUES, LOWER, SPACES, kept, lookup, span_hashes, word_spans
from revspark.llm.piece_table import PieceTable
from revspark.llm.pretoken import Classes, split

MAX_PIECES = 2_000_000  # pieces a worker remembers; later ones are encoded in each batch anew
NOT_ASCII_SPACE = lookup(SPACES)
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
STOPS = b".,;:!?"  # pieces of their own behind an ASCII letter, if the file takes them apart too


class Encoder:
    """``__call__(texts)``: ids of all texts in one array, and the number of ids of each."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        byte_level = type(self.library.pre_tokenizer).__name__ == "ByteLevel"
        self.classes = Classes(self.library.pre_tokenizer) if byte_level else None
        self.lower, self.stops = False, np.zeros(256, bool)
        if self.classes is None:
            normal = self.library.normalizer
            self.lower = normal is not None and normal.normalize_str("AZ") == "az"
            self.stops[[b for b in STOPS if self._apart(chr(b))]] = True
        self.mapped = self._letters() if self.classes is None else {}
        self.letters_only = re.compile(
            "[" + "".join(map(re.escape, self.mapped)) + "]+" if self.mapped else r"(?!)").fullmatch
        self.written = {ord(c): m for c, m in self.mapped.items() if c != m}
        self.model = self.library.model
        self.table = PieceTable(MAX_PIECES)
        self.ids = np.zeros(0, np.uint16)  # of the known pieces
        self.start = np.zeros(MAX_PIECES, np.int32)
        self.count = np.zeros(MAX_PIECES, np.int32)

    def _apart(self, stop: str) -> bool:
        """Whether a run of stops behind a letter is a piece of its own."""
        ids = lambda text: self.library.encode(text, add_special_tokens=False).ids
        return all(ids("ab" + x) == ids("ab") + ids(x) for x in (stop, stop * 3, stop + ".,!"))

    def _letters(self) -> dict[str, str]:
        """Small letters that the file's normalizer leaves alone and its pre-tokenizer keeps together,
        and what it writes for each: words of these alone are given to the model as they are."""
        normal, split, out = self.library.normalizer, self.library.pre_tokenizer, {}
        for c in map(chr, range(0x61, 0x180)):
            word = f"a{c}b"
            if c.isalpha() and (normal is None or normal.normalize_str(word) == word):
                found = split.pre_tokenize_str(word) if split is not None else []
                if len(found) == 1 and found[0][0][:1] + found[0][0][-1:] == "ab":
                    out[c] = found[0][0][1:-1]
        return out

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, each encoded by itself, and the number of ids of each."""
        plain = np.array([self.letters_only(p) is not None for p in pieces], bool)
        counts, parts = np.zeros(len(pieces), np.int64), []
        words, own = [], []
        for at in np.flatnonzero(plain).tolist():
            word = pieces[at] if pieces[at].isascii() else pieces[at].translate(self.written)
            found = [t.id for t in self.model.tokenize(word)]
            words += found
            own.append(len(found))
        counts[plain] = own
        parts.append((np.flatnonzero(plain), np.array(words, np.int32)))
        others = np.flatnonzero(~plain)
        for i in range(0, len(others), 4096):
            some = others[i:i + 4096]
            found = self.library.encode([pieces[k] for k in some.tolist()], is_pretokenized=True,
                                        add_special_tokens=False)
            counts[some] = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
            parts.append((some, np.array(found.ids, np.int32)))
        starts, out = np.cumsum(counts) - counts, np.empty(int(counts.sum()), np.int32)
        for which, ids in parts:
            n = counts[which]
            out[np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def _split(self, texts: list[str]):
        if self.classes is not None:
            return split(texts, self.classes)
        rows = [t.encode("utf-8", "surrogatepass") for t in texts]
        whole = b"".join(rows)
        data = np.frombuffer(whole, np.uint8)
        offs = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))])
        if self.lower:
            data = LOWER[data]
            whole = data.tobytes()
        starts, ends, before = word_spans(data, offs, NOT_ASCII_SPACE)
        if len(starts) and self.stops.any():
            # Where the stops at a word's end begin; apart if a letter is before them.
            at = np.flatnonzero(self.stops[data[ends - 1]])
            first, cuts, going = starts[at], ends[at] - 1, np.arange(len(at))
            while len(going):
                more = (cuts[going] > first[going]) & self.stops[data[cuts[going] - 1]]
                going = going[more]
                cuts[going] -= 1
            cuts = cuts[(cuts > first) & ASCII_LETTER[data[cuts - 1]]]
            starts, ends = (np.sort(np.concatenate([x, cuts]), kind="stable") for x in (starts, ends))
            before = np.searchsorted(starts, offs)
        return whole, starts, ends, span_hashes(BYTE_VALUES[data], starts, ends), np.diff(before)

    def _new(self, whole, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encode the distinct pieces among those not known; keep them while there is room."""
        new, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        texts = [whole[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        if isinstance(whole, bytes):
            texts = [t.decode("utf-8") for t in texts]
        ids, counts = self._encode(texts)
        size = self.table.size
        n = self.table.add(new)
        first_ids = int(counts[:n].sum())
        self.start[size:size + n] = len(self.ids) + np.cumsum(counts[:n]) - counts[:n]
        self.count[size:size + n] = counts[:n]
        self.ids = np.concatenate([self.ids, ids[:first_ids].astype(np.uint16)])
        return ids, (np.cumsum(counts) - counts)[back], counts[back]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.specials)]
        plain = texts
        if odd:
            plain = list(texts)
            for i in odd:
                plain[i] = ""
        whole, starts, ends, hashes, per_text = self._split(plain)
        at = self.table.get(hashes)
        known, pool = self.ids, self.ids
        start, count = self.start[at].astype(np.int64), self.count[at].astype(np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            ids, own, sizes = self._new(whole, starts[missing], ends[missing], hashes[missing])
            pool = np.concatenate([known.astype(np.int32), ids])
            start[missing], count[missing] = len(known) + own, sizes
        stops = np.cumsum(count)
        total = int(stops[-1]) if len(stops) else 0
        ids = pool[np.repeat(start - (stops - count), count) + np.arange(total)].astype(np.int32)
        bounds = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(per_text)])]
        if not odd:
            return ids, np.diff(bounds)
        parts = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        found = self.library.encode_batch([texts[i] for i in odd], add_special_tokens=False)
        for i, x in zip(odd, found):
            parts[i] = np.array(x.ids, np.int32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


def encoder(name: str) -> Encoder:
    """The worker's encoder for a public tokenizer file."""
    import public_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return kept(("ids", name), lambda: Encoder(public_tokenizers.path(name)))
