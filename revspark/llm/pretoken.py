"""Pre-tokenisation of byte-level BPE texts by a deterministic transducer over character classes.

The splitting rule (contractions; runs of letters, digits or other signs, each with one space
before it; white space) is a finite-state machine whose transitions say where a piece begins.
A text of any length is cut into chunks; every chunk's state map (entry state -> exit state) is
computed for all chunks in step, the maps compose by a parallel prefix scan, and a second pass
from each chunk's now known entry state emits the piece boundaries.
"""

from __future__ import annotations

import numpy as np

from revspark.llm.common import span_hashes

# ---- fixed values: character classes and states of the splitting rule -------------------------
SP, WS, LET, NUM, OTH, APO, STMD, R_V, E_, L_, END = range(11)  # R_V: r and v; STMD: s, t, m, d
N_CLASSES = 11
LETTERS = (LET, STMD, R_V, E_, L_)
START, IN_L, IN_N, IN_O, SP1, SP2, WS1, WS2, APOS, APOS_RV, APOS_L, DONE = range(12)
N_STATES = 12
HERE, BEFORE = 1, 2  # a piece begins at this character; one begins at the character before it
SPECIAL = "<|endoftext|>"
# ----------------------------------------------------------------------------------------------
SENTINEL = 0x110000  # ends a text
UNKNOWN = 255


def _enter(c: int) -> int:
    if c == END:
        return START
    if c in LETTERS:
        return IN_L
    return {SP: SP1, WS: WS1, NUM: IN_N, OTH: IN_O, APO: APOS}[c]


def _step(state: int, c: int) -> tuple[int, int]:
    """(next state, emission) of the splitting rule."""
    new = (_enter(c), HERE)
    if c == END:
        return START, HERE | (BEFORE if state in (APOS_RV, APOS_L) else 0)
    if state in (START, DONE):
        return new
    if state == IN_L:
        return (IN_L, 0) if c in LETTERS else new
    if state == IN_N:
        return (IN_N, 0) if c == NUM else new
    if state == IN_O:
        return (IN_O, 0) if c in (OTH, APO) else new
    if state in (SP1, SP2, WS1, WS2):
        if c in (SP, WS):  # the run of white space goes on
            return (SP2 if c == SP else WS2), 0
        if state in (SP1, SP2):  # the run's last space belongs to what follows
            joined = IN_O if c == APO else _enter(c)
            return joined, (BEFORE if state == SP2 else 0)
        return _enter(c), HERE | (BEFORE if state == WS2 else 0)
    if state == APOS:
        if c == STMD:
            return DONE, 0
        if c == R_V:
            return APOS_RV, 0
        if c == L_:
            return APOS_L, 0
        return (IN_O, 0) if c in (OTH, APO) else new
    # an apostrophe and r, v or l: a contraction only with the right letter next
    if c == (E_ if state == APOS_RV else L_):
        return DONE, 0
    return (IN_L, BEFORE) if c in LETTERS else (_enter(c), HERE | BEFORE)


_STEPS = [[_step(s, c) for c in range(N_CLASSES)] for s in range(N_STATES)]
NEXT = np.array([[x[0] for x in row] for row in _STEPS], np.uint8).ravel()
EMIT = np.array([[x[1] for x in row] for row in _STEPS], np.uint8).ravel()
CHUNK = 256


class Classes:
    """Class of every code point, asked of the library's own pre-tokenizer when first met."""

    def __init__(self, pre_tokenizer):
        self.split = pre_tokenizer.pre_tokenize_str
        self.table = np.full(SENTINEL + 1, UNKNOWN, np.uint8)
        self.table[SENTINEL] = END
        for char, c in ((" ", SP), ("'", APO), ("r", R_V), ("v", R_V), ("e", E_), ("l", L_),
                        *((x, STMD) for x in "stmd")):
            self.table[ord(char)] = c

    def _class(self, char: str) -> int:
        for joined, c in (("a", LET), ("1", NUM), ("!", OTH)):
            if len(self.split(joined + char)) == 1:
                return c
        return WS

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        if (found == UNKNOWN).any():
            for p in np.unique(points[found == UNKNOWN]):
                self.table[p] = self._class(chr(p))
            found = self.table[points]
        return found


def chunk_maps(columns: np.ndarray) -> np.ndarray:
    """Exit state of every chunk (a column) for every entry state: (states, chunks)."""
    chunks = columns.shape[1]
    states = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], chunks, axis=1)
    for i, row in enumerate(columns):
        states = NEXT[states * np.uint8(N_CLASSES) + row]
        if i % 16 == 15 and len(states) > 1 and (states == states[0]).all():
            states = states[:1]  # every entry state has led to the same state
    return np.broadcast_to(states, (N_STATES, chunks))


def compose_maps(maps: np.ndarray) -> np.ndarray:
    """Prefix compositions of the chunks' maps by a parallel scan in log2(chunks) steps."""
    prefix = np.ascontiguousarray(maps.T)
    d = 1
    while d < len(prefix):
        prefix[d:] = np.take_along_axis(prefix[d:], prefix[:-d].astype(np.intp), axis=1)
        d *= 2
    return prefix


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Positions at which a piece begins (an ``END`` begins one too)."""
    n = len(classes)
    if n == 0:
        return np.zeros(0, np.int64)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, END, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    prefix = compose_maps(chunk_maps(columns))
    states = np.empty(chunks, np.uint8)
    states[0] = START
    states[1:] = prefix[:-1, START]
    marks = np.empty((CHUNK, chunks), np.uint8)
    for i, row in enumerate(columns):
        at = states * np.uint8(N_CLASSES) + row
        marks[i] = EMIT[at]
        states = NEXT[at]
    flat = np.ascontiguousarray(marks.T).ravel()
    begins = (flat & HERE).astype(bool)
    begins[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return np.flatnonzero(begins[:n])


def split(texts: list[str], classes: Classes
          ) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined; start, end and 64-bit hash of every piece of all texts in order; and the
    number of pieces of each text."""
    whole = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    stops = np.cumsum(lengths)
    with_stops = np.insert(points, stops, SENTINEL)
    starts = piece_starts(classes(with_stops))
    text_of = np.searchsorted(stops + np.arange(len(texts)), starts)  # its END's place
    real = with_stops[starts] != SENTINEL
    starts = (starts - text_of)[real]  # places in `whole`
    counts = np.bincount(text_of[real], minlength=len(texts))
    ends = np.append(starts[1:], len(whole))[:len(starts)]
    values = points.astype(np.uint64) + np.uint64(1)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return whole, starts, ends, span_hashes(values, starts, ends), counts
