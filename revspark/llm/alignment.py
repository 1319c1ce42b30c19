"""Alignment of two tokenizers over whole texts: groups of tokens that cover the same bytes, and how
often tokens of one overlap tokens of the other in the whole corpus.

Tokens and byte ends come from ``spans``. Byte offsets at which tokens of both end cut a text into
groups. Between two neighbouring ends of either kind lies exactly one overlapping pair of tokens (a
link), so links are the ends merged: as many as tokens of both, less the groups.

Plan:

1. Runs: a map task aligns its documents by the megabyte and closes a run at ``RUN_BYTES`` of text.
   A run is one written row: its documents' figures, its distinct (A id, B id) pairs with counts, and
   for each document which of the run's pairs it holds how often (packed). Nothing is shuffled.
2. Corpus counts: the runs' pairs are summed with partial aggregates. Each pair is there once a run at
   most, however many documents hold it, so a hot pair is no hot key. The highest count of each B
   id is at most one number per vocabulary entry; that table is broadcast (its size is bounded by
   the vocabulary, whatever the corpus).
3. Answers: the counts are joined to the runs' pairs, go back to their run, and each run's documents
   sum theirs in numpy. A task holds one run.

Defined results: texts that are null or empty, or whose tokens of either kind don't spell the text
with a space before it, have no tokens: zeros and an empty ``groups_sha256``. Ids may be null or
repeated: each row is judged by itself. Texts of any length are one document of a run. Extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import give_back, id_and_text, slices, written
from revspark.llm.spans import Tokens, _by_text, tokenizer_pair

RUN_BYTES = 8 << 20
WIDTH = 1 << 15  # a pair's code: A id * WIDTH + B id; fits a signed 32-bit number
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
RUNS = ("run long, pairs array<int>, counts array<int>, doc_id array<long>, "
        + ", ".join(f"{c} array<long>" for c in FIGURES)
        + ", sha array<string>, n_pairs array<int>, held binary")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups_sha256 string")
# Decimal digits of every id below 2**16, and how many there are.
_IDS = np.arange(1 << 16)
_DIGITS = 1 + sum((_IDS >= 10**k).astype(np.int64) for k in range(1, 5))
_TEXT = np.zeros((1 << 16, 6), np.uint8)
for _k in range(5):
    _has = _DIGITS > _k
    _TEXT[_has, _k] = 48 + (_IDS[_has] // 10 ** (_DIGITS[_has] - 1 - _k)) % 10


class Alignment:
    """Groups and links of a batch of texts, each spelt by both tokenizers' tokens."""

    def __init__(self, a: Tokens, b: Tokens):
        self.n_a, self.n_b = a.counts, b.counts
        ends_a, ends_b = np.cumsum(a.sizes, dtype=np.int64), np.cumsum(b.sizes, dtype=np.int64)
        total = int(ends_a[-1]) if len(ends_a) else 0
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[ends_a] = True
        at_b[ends_b] = True
        both, either = at_a & at_b, at_a | at_b
        merged = np.flatnonzero(either)
        until = lambda marks: np.cumsum(marks, dtype=np.int32)
        groups = until(both)
        # Of each link: its tokens; of each token: its group. Ends of texts are ends of both.
        self.link_a = a.ids[until(at_a)[merged] - at_a[merged]]
        self.link_b = b.ids[until(at_b)[merged] - at_b[merged]]
        self.last_a, self.last_b = both[ends_a], both[ends_b]
        self.group_a, self.group_b = groups[ends_a] - self.last_a, groups[ends_b] - self.last_b
        self.ids_a, self.ids_b = a.ids, b.ids
        stops = np.concatenate([[0], np.cumsum(_by_text_sizes(a))])
        self.n_groups = np.diff(groups[stops]).astype(np.int64)
        self.n_links = np.diff(until(either)[stops]).astype(np.int64)

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each text: decimal ids of each group's A and B tokens in order."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        groups = int(self.group_a[-1]) + 1 if n_a else 0
        a_until = np.cumsum(np.bincount(self.group_a, minlength=groups))
        b_until = np.cumsum(np.bincount(self.group_b, minlength=groups))
        b_before = b_until - np.bincount(self.group_b, minlength=groups)
        ids, ends = np.empty(n_a + n_b, np.int64), np.empty(n_a + n_b, np.uint8)
        at = np.arange(n_a) + b_before[self.group_a]
        ids[at], ends[at] = self.ids_a, np.where(self.last_a, ord("|"), ord(","))
        at = np.arange(n_b) + a_until[self.group_b]
        ids[at], ends[at] = self.ids_b, np.where(self.last_b, ord(";"), ord(","))
        lengths = _DIGITS[ids] + 1
        shown = _TEXT[ids]
        shown[np.arange(len(ids)), lengths - 1] = ends
        flat = shown[np.arange(6) < lengths[:, None]]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        bounds = stops[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        # Without the sign behind a text's last group.
        return [flat[x:max(x, y - 1)].tobytes() for x, y in zip(bounds, bounds[1:])]


def _by_text_sizes(tokens: Tokens) -> np.ndarray:
    return _by_text(tokens.sizes.astype(np.int64), tokens.counts, np.add)


def _only(tokens: Tokens, good: np.ndarray) -> Tokens:
    """The tokens of some texts; the others have none."""
    if good.all():
        return tokens
    keep = np.repeat(good, tokens.counts)
    return Tokens(tokens.ids[keep], tokens.sizes[keep], np.where(good, tokens.counts, 0), good)


def align(texts: list[str], pair) -> tuple[Alignment, np.ndarray]:
    """Alignment of texts, and which of them have tokens."""
    byte_level, sentence_piece = pair
    spaced = [f" {t}" if t else "" for t in texts]
    a, b = byte_level(spaced), sentence_piece(spaced)
    good = a.whole & b.whole & (a.counts > 0) & (b.counts > 0)
    return Alignment(_only(a, good), _only(b, good)), good


def _plane(values: np.ndarray) -> np.ndarray:
    """Bytes of 32-bit numbers, lowest ones first: high bytes, mostly zero, lie together."""
    return np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each is there."""
    values = np.sort(values)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return values[first], np.diff(np.append(first, len(values)))


class _Run:
    """Documents of one run, until it is written."""

    def __init__(self) -> None:
        self.columns: dict[str, list] = {c: [] for c in ("doc_id", *FIGURES, "sha", "n_pairs")}
        self.codes: list[np.ndarray] = []  # of each document's distinct pairs, ascending
        self.times: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_ids: list, found: Alignment, good: np.ndarray, shas: list) -> None:
        code = found.link_a.astype(np.int64) * WIDTH + found.link_b
        document = np.repeat(np.arange(len(doc_ids)), found.n_links)
        key, times = _distinct(document << 32 | code)
        self.codes.append((key & 0xFFFFFFFF).astype(np.uint32))
        self.times.append(times.astype(np.uint32))
        c = self.columns
        c["doc_id"] += doc_ids
        for name in FIGURES:
            c[name] += getattr(found, name).tolist()
        c["sha"] += shas
        c["n_pairs"] += np.bincount(key >> 32, minlength=len(doc_ids)).tolist()

    def row(self, run: int) -> pa.RecordBatch:
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
        times = np.concatenate(self.times) if self.times else np.zeros(0, np.uint32)
        pairs, _ = _distinct(codes)
        at = np.searchsorted(pairs, codes)
        counts = np.bincount(at, weights=times, minlength=len(pairs)).astype(np.int32)
        # Places of a document's pairs as steps from the one before: small numbers.
        steps = np.diff(at, prepend=0)
        n = np.array(self.columns["n_pairs"], np.int64)
        first = (np.cumsum(n) - n)[n > 0]
        steps[first] = at[first]
        held = zlib.compress(_plane(steps).tobytes() + _plane(times).tobytes(), 1)
        lists = [pa.array([pairs.astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([counts], pa.list_(pa.int32())),
                 *[pa.array([self.columns[c]], pa.list_(pa.int64())) for c in ("doc_id", *FIGURES)],
                 pa.array([self.columns["sha"]], pa.list_(pa.string())),
                 pa.array([self.columns["n_pairs"]], pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(
            [pa.array([run], pa.int64()), *lists, pa.array([held], pa.binary())],
            names=["run", "pairs", "counts", "doc_id", *FIGURES, "sha", "n_pairs", "held"])


def _unpacked(held: bytes, n_pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the run's pairs and multiplicities, document by document."""
    total = int(n_pairs.sum())
    raw = np.frombuffer(zlib.decompress(held), np.uint8)
    steps, times = (np.ascontiguousarray(raw[x:x + 4 * total].reshape(4, total).T).view("<u4")
                    .reshape(total).astype(np.int64) for x in (0, 4 * total))
    sums = np.cumsum(steps)
    first = np.cumsum(n_pairs) - n_pairs
    before = np.concatenate([[0], sums])[first]
    return sums - np.repeat(before, n_pairs), times


def _runs(docs: DataFrame, byte_level: str, sentence_piece: str, run_bytes: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_level, sentence_piece)
        part, number, run = TaskContext.get().partitionId(), 0, _Run()
        for batch in slices(batches, "text", keep=True):
            texts = batch.column(1).to_pylist()
            found, good = align(texts, pair)
            shas = [hashlib.sha256(g).hexdigest() if ok else ""
                    for g, ok in zip(found.groups(), good.tolist())]
            run.add(batch.column(0).to_pylist(), found, good, shas)
            run.bytes += sum(map(len, texts))
            if run.bytes >= run_bytes:
                yield run.row(part << 32 | number)
                number, run = number + 1, _Run()
                give_back()
        if run.columns["doc_id"]:
            yield run.row(part << 32 | number)

    return written(docs.mapInArrow(work, RUNS), "aligned-runs", merge=False)


def pair_counts(runs: DataFrame) -> DataFrame:
    """pair, n (links of the corpus that hold it), best (no pair of its B id has more)."""
    pairs = runs.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    totals = written(totals, "pair-counts", merge=False)
    b = F.col("pair") % WIDTH
    highest = totals.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    # One row for each entry of B's vocabulary at most.
    return totals.join(F.broadcast(highest), b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _answer(runs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of one run with what the corpus says of their links."""
    at = answers.column("at").to_numpy()
    n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    n[at] = answers.column("n").to_numpy()
    best[at] = answers.column("best").to_numpy(zero_copy_only=False)
    row = {c: runs.column(c)[0] for c in runs.column_names}
    n_pairs = np.array(row["n_pairs"].as_py(), np.int64)
    places, times = _unpacked(row["held"].as_py(), n_pairs)
    sums = np.concatenate([[[0, 0]], np.cumsum(
        np.stack([times * best[places], times * n[places]], 1), axis=0)])
    stops = np.concatenate([[0], np.cumsum(n_pairs)])
    per_doc = sums[stops[1:]] - sums[stops[:-1]]
    columns = {c: row[c].values for c in ("doc_id", *FIGURES)}
    return pa.table({**columns, "n_best": per_doc[:, 0], "count_sum": per_doc[:, 1],
                     "groups_sha256": row["sha"].values})


def aligned(df: DataFrame, byte_level: str, sentence_piece: str, id_col: str = "doc_id",
            text_col: str = "text", run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair no other pair of its B id outnumbers in the corpus), count_sum (of the links' pairs'
    corpus counts) and groups_sha256."""
    runs = _runs(id_and_text(df, id_col, text_col), byte_level, sentence_piece, run_bytes)
    asked = runs.select("run", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(pair_counts(runs), "pair").select(
        F.col("run").alias("asker"), "at", "n", "best")
    documents = runs.drop("pairs", "counts")
    both = documents.groupBy("run").cogroup(answers.groupBy("asker"))
    return both.applyInArrow(_answer, ALIGNED)


def token_groups(df: DataFrame, byte_level: str, sentence_piece: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id and ``groups`` of every row, as they are hashed (``a1,a2|b1;a3|b2``; '' without
    tokens)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_level, sentence_piece)
        for batch in slices(batches, "text", keep=True):
            found, _ = align(batch.column(1).to_pylist(), pair)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g.decode() for g in found.groups()])],
                names=["doc_id", "groups"])

    return id_and_text(df, id_col, text_col).mapInArrow(work, "doc_id long, groups string")
