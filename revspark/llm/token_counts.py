"""Token counts by finite-state transducers compiled from a tokenizer file.

Two machines, both deterministic:

* ``pretoken``: splits texts into pieces; chunk state maps compose by a parallel prefix scan.
* ``CountTransducer``: reads a piece byte by byte; its transitions carry the change of the number
  of emitted tokens. A state holds the longest suffix that can still grow into a token, and for
  each place in it the last token of the BPE result up to there. Transitions are compiled from
  the merge list when first taken, and the counts of whole pieces are remembered.

A document is one row of a narrow map: no shuffle, whole texts, bounded memory (texts are worked
on in pieces of a few MB and the compiled tables are dropped at a fixed size).

Defined results: a null text is empty and has 0 bytes and tokens; the file's special string
inside a text counts as one token (the library's default); repeated rows and null ids come back
as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import id_and_text, kept, slices, utf8
from revspark.llm.piece_table import PieceTable
from revspark.llm.pretoken import SPECIAL, Classes, split

LIMIT = 1024
MAX_PIECES = 1_000_000  # pieces a worker remembers; later ones run through the transducer
MAX_TRANSITIONS = 500_000  # compiled transitions of a worker, after which it starts anew


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: visible Latin-1 characters stand for
    themselves, the other bytes for the characters from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class CountTransducer:
    """Deterministic machine over bytes; ``count(piece)`` is the number of its BPE tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        self.rank = {}
        for i, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[bytes(alphabet[c] for c in a), bytes(alphabet[c] for c in b)] = i
        self.tokens = {a + b for a, b in self.rank} | {bytes([b]) for b in range(256)}
        self.longest = max(map(len, self.tokens))
        self.prefixes = {t[:k] for t in self.tokens for k in range(len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.forget()

    def forget(self) -> None:
        start = (b"", (None,), (0,))
        self.states, self.ids = [start], {start: 0}
        self.transitions: dict[int, tuple[int, int]] = {}

    def merge(self, text: bytes) -> list[bytes]:
        """BPE by its definition: join the pair of lowest rank until none is left."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 40) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 40:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def follows(self, before: bytes | None, token: bytes) -> bool:
        """Whether BPE leaves ``token`` as the last token behind a last token ``before``."""
        key = (before, token)
        known = self.pairs.get(key)
        if known is None:
            parts = [token] if before is None else [before, token]
            if len(self.pairs) > 2 * MAX_TRANSITIONS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(b"".join(parts)) == parts
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of ``state`` by ``byte``: (next state, tokens emitted more or less)."""
        tail, last, counts = self.states[state]
        text = tail + bytes([byte])
        for k in range(len(text)):  # the longest token that fits
            token = text[k:]
            if token in self.tokens and self.follows(last[k], token):
                count = counts[k] + 1
                break
        else:
            raise ValueError("a byte outside the vocabulary")
        last, counts = (*last, token), (*counts, count)
        k = next(k for k in range(len(text) + 1) if text[k:] in self.prefixes)
        new = (text[k:], last[k:], tuple(c - count for c in counts[k:]))
        at = self.ids.get(new)
        if at is None:
            at = self.ids[new] = len(self.states)
            self.states.append(new)
        self.transitions[state << 8 | byte] = out = (at, count)
        return out

    def count(self, piece: bytes) -> int:
        if len(self.transitions) > MAX_TRANSITIONS:
            self.forget()
        state = total = 0
        known = self.transitions
        for byte in piece:
            step = known.get(state << 8 | byte)
            state, more = step or self.compile(state, byte)
            total += more
        return total


class TokenCounter:
    """Token counts of whole texts, for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.classes = Classes(Tokenizer.from_file(path).pre_tokenizer)
        self.transducer = CountTransducer(path)
        self.table = PieceTable(MAX_PIECES)
        self.known = np.zeros(MAX_PIECES, np.int32)

    def _counts(self, whole: str, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
                ) -> np.ndarray:
        at = self.table.get(hashes)
        counts = self.known[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, first, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            own = np.array([self.transducer.count(whole[a:b].encode("utf-8", "surrogatepass"))
                            for a, b in zip(starts[missing[first]].tolist(),
                                            ends[missing[first]].tolist())], np.int32)
            counts[missing] = own[back]
            size = self.table.size
            n = self.table.add(new)
            self.known[size:size + n] = own[:n]
        return counts

    def __call__(self, texts: list[str]) -> np.ndarray:
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            within = text.split(SPECIAL) if SPECIAL in text else [text]
            extra[i] = len(within) - 1
            parts += within
            owner += [i] * len(within)
        whole, starts, ends, hashes, per_part = split(parts, self.classes)
        counts = self._counts(whole, starts, ends, hashes)
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        stops = np.cumsum(per_part)
        tokens = sums[stops] - sums[stops - per_part]
        return extra + np.bincount(owner, tokens, len(texts)).astype(np.int64)


def counter(path: str) -> TokenCounter:
    """The worker's counter for a file (compiled once)."""
    return kept(("counts", path), lambda: TokenCounter(path))


def token_counts(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row.

    ``tokenizer``: name of a byte-level BPE file, found by ``public_tokenizers.path``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        counts = counter(public_tokenizers.path(tokenizer))
        for batch in slices(batches, "text", keep=True):
            _, offs = utf8(batch.column(1))
            tokens = counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offs)), pa.array(tokens)],
                names=["doc_id", "n_bytes", "n_tokens"])

    counted = id_and_text(df, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
