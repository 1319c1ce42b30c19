"""Quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its whole text: shares of neighbouring character
classes, and how words and lines repeat. In a preference pair a labelled good document stands before
a labelled bad one, and the weights minimise the logistic loss of the pairs' feature differences. The
cut between good and bad is a quantile of the labelled strengths: the share of bad documents among all
labelled ones. Scores are the logistic function of the strength's distance from the cut, shifted so
that the cut lies at ``THRESHOLD``.

Training takes every labelled document that isn't held out. They are dealt into blocks of at most
``MAX_EACH`` of either kind, so that each block has the labels' shares of both; a kind with fewer
documents than there are blocks is repeated, so that none lacks it. A block is one task's work: in it,
``PAIRS`` pairs are drawn, and each document that none of them holds gets one more. The weights are the
mean of the blocks' weights. The cut is taken from the strengths of all labelled documents, by counting
them in ranges. The driver sees a block's weights and the ranges' counts.

Features (a fixed number for each document) are computed once, written, and read by the training and by
the scoring.

Defined results: a null or empty text has the features of no text; a null id is not held out;
several labels of one id count as the smallest; without both kinds of labels every score is 0.5;
repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revspark.llm.common import (
    BYTE_VALUES,
    LOWER,
    SPACES,
    crc_mod,
    id_and_text,
    lookup,
    slices,
    span_hashes,
    utf8,
    word_spans,
    written,
)

MAX_EACH = 4000  # labelled documents of either kind in a block
PAIRS = 20_000  # drawn in a block
POINTS = 2000  # fewer labelled strengths are interpolated to as many
RANGES = 1024
THRESHOLD = 0.3
STEPS, RATE, PENALTY = 400, 0.05, 1e-4

LOWER_CASE, UPPER_CASE, DIGIT, SPACE, LINE, STOP, SIGN, OTHER = range(8)
CLASSES = np.full(256, SIGN, np.uint8)
CLASSES[97:123] = LOWER_CASE
CLASSES[65:91] = UPPER_CASE
CLASSES[48:58] = DIGIT
CLASSES[[9, 11, 12, 32]] = SPACE
CLASSES[[10, 13]] = LINE
CLASSES[[ord(c) for c in ".,;:'\"-()?"]] = STOP
CLASSES[128:] = OTHER
N_FEATURES = 64 + 8
NOT_SPACE = lookup(SPACES)
NOT_LINE = lookup([10, 13])


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    return count / np.maximum(total, 1)


def repeats(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the number of distinct hashes, and the count of the most frequent one."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(r)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[first], counts)
    return np.bincount(r[first], minlength=n), most


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, N_FEATURES) of whole texts."""
    n = len(offs) - 1
    sizes = np.diff(offs)
    row = np.repeat(np.arange(n), sizes)
    out = np.zeros((n, N_FEATURES))
    values = BYTE_VALUES[LOWER[data]]
    if len(data):
        classes = CLASSES[data].astype(np.int64)
        inner = row[1:] == row[:-1]
        code = row[:-1][inner] * 64 + classes[:-1][inner] * 8 + classes[1:][inner]
        pairs = np.bincount(code, minlength=64 * n).reshape(n, 64)
        out[:, :64] = np.sqrt(shares(pairs, sizes[:, None]))
    starts, ends, before = word_spans(data, offs, NOT_SPACE)
    words = np.diff(before)
    if len(starts):
        hashes = span_hashes(values, starts, ends)
        of = np.repeat(np.arange(n), words)
        distinct, most = repeats(of, hashes, n)
        same = of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])]
        out[:, 64] = shares(distinct, words)
        out[:, 65] = np.sqrt(shares(most, words))
        out[:, 66] = np.sqrt(shares(np.bincount(same, minlength=n), words))
        out[:, 67] = shares(np.bincount(of, ends - starts, n), words) / 10
    starts, ends, before = word_spans(data, offs, NOT_LINE)
    lines = np.diff(before)
    if len(starts):
        of = np.repeat(np.arange(n), lines)
        distinct, _ = repeats(of, span_hashes(values, starts, ends), n)
        out[:, 68] = 1 - shares(distinct, lines)
        out[:, 69] = np.log1p(shares(sizes, lines)) / 10
    out[:, 70] = np.log1p(words) / 10
    out[:, 71] = words == 0
    return out


@dataclass
class Model:
    weights: np.ndarray
    cut: float
    scale: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(THRESHOLD / (1 - THRESHOLD)) if self.weights.any() else 0.0
        return 1 / (1 + np.exp(-np.clip((x @ self.weights - self.cut) * self.scale + shift,
                                        -700, 700)))


def train_bradley_terry(better: np.ndarray, worse: np.ndarray, steps: int = STEPS,
                        rate: float = RATE, penalty: float = PENALTY) -> np.ndarray:
    """Weights by logistic loss on the differences better - worse of preference pairs."""
    differences = better - worse
    theta = np.zeros(differences.shape[1])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        slope = -1 / (1 + np.exp(np.clip(differences @ theta, -50, 50)))
        gradient = slope @ differences / len(differences) + penalty * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta


def quantile_cut(strengths: np.ndarray, share: float) -> float:
    """Half way between the neighbouring strengths at the quantile ``share``."""
    ordered = np.sort(strengths)
    at = min(max(int(round(share * len(ordered))), 1), len(ordered) - 1)
    return float(ordered[at - 1] + ordered[at]) / 2


def fit_block(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS) -> np.ndarray:
    """Weights from preference pairs in which every document of both kinds takes part."""
    rng = np.random.default_rng(11)
    a, b = rng.integers(0, len(good), pairs), rng.integers(0, len(bad), pairs)
    more_a, more_b = (np.setdiff1d(np.arange(n), drawn) for n, drawn in ((len(good), a), (len(bad), b)))
    a, b = (np.concatenate([a, more_a, rng.integers(0, len(good), len(more_b))]),
            np.concatenate([b, rng.integers(0, len(bad), len(more_a)), more_b]))
    centre, spread = np.concatenate([good, bad]).mean(0), np.concatenate([good, bad]).std(0) + 1e-3
    return train_bradley_terry((good[a] - centre) / spread, (bad[b] - centre) / spread) / spread


def matrix(column: pa.Array) -> np.ndarray:
    """(rows, N_FEATURES) of a column of features."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, N_FEATURES)


def described(documents: DataFrame) -> DataFrame:
    """doc_id and features of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(*utf8(batch.column(1)))
            borders = np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(borders, pa.array(x.ravel()))],
                names=["doc_id", "x"])

    return id_and_text(documents).mapInArrow(work, "doc_id long, x array<double>")


def dealt(known: DataFrame, totals: dict[int, int], max_each: int) -> DataFrame:
    """``known`` (doc_id, quality) with the blocks that each document goes to, an array: one of them,
    or of a kind with fewer documents than blocks, every so many."""
    blocks = -(-max(totals.values()) // max_each)
    placed = known.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    before = Window.partitionBy("quality").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)  # over a row for each part
    parts = placed.groupBy("quality", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "quality", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.row_number().over(
        Window.partitionBy("quality", "part").orderBy("doc_id")) - 1
    step = F.when(F.col("quality") == 0, F.lit(totals[0])).otherwise(F.lit(totals[1]))
    return placed.join(F.broadcast(parts), ["quality", "part"]).withColumn("rank", rank).select(
        "doc_id", "quality",
        F.sequence(F.col("rank") % blocks, F.lit(blocks - 1).cast("long"),
                   step.cast("long")).alias("blocks"))


def mean_weights(labelled: DataFrame) -> np.ndarray:
    """The mean of the weights of all blocks."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        x, kinds = matrix(table.column("x")), table.column("quality").to_numpy()
        weights = fit_block(x[kinds == 1], x[kinds == 0])
        return pa.table({"block": table.column("block")[:1],
                         "weights": pa.array([weights], pa.list_(pa.float64()))})

    rows = labelled.select("doc_id", "quality", "x", F.explode("blocks").alias("block"))
    found = rows.groupBy("block").applyInArrow(work, "block long, weights array<double>").collect()
    return np.mean([r["weights"] for r in sorted(found)], axis=0)


def at_rank(strengths: DataFrame, rank: int) -> float:
    """The strength that has ``rank`` others before it in order. The range that holds it is cut into
    ``RANGES``, and again, until all in it are equal."""
    s = F.col("strength")
    ends = [F.min(s).alias("low"), F.max(s).alias("high")]
    low, high = strengths.agg(*ends).first()
    while low < high:
        place = F.floor((s - F.lit(low)) / F.lit(high - low) * RANGES).alias("place")
        inside = strengths.where(s.between(low, high)).groupBy(place)
        for r in sorted(inside.agg(F.count(F.lit(1)).alias("n"), *ends).collect()):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    return float(low)


def cut_of(strengths: DataFrame, totals: dict[int, int], points: int = POINTS) -> float:
    """The quantile of all labelled strengths (quality, strength) at the share of bad ones; of fewer
    than ``points`` strengths, each kind's quantiles are spread over as many."""
    n = totals[0] + totals[1]
    if n >= points:
        return (at_rank(strengths, totals[0] - 1) + at_rank(strengths, totals[0])) / 2
    of = {0: [], 1: []}
    for r in strengths.collect():  # fewer than ``points``
        of[r["quality"]].append(r["strength"])
    n_bad = min(max(1, round(totals[0] / n * points)), points - 1)
    kinds = [np.quantile(of[kind], (np.arange(k) + 0.5) / k)
             for kind, k in ((0, n_bad), (1, points - n_bad))]
    return quantile_cut(np.concatenate(kinds), n_bad / points)


def fit_from_labels(rows: DataFrame, labels: DataFrame, modulus: int = 5,
                    remainder: int = 0, max_each: int = MAX_EACH) -> Model:
    """Train on all labelled rows of ``described`` whose crc32(doc_id) mod ``modulus`` isn't
    ``remainder``."""
    rows = rows.where("doc_id IS NOT NULL")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("quality").cast("int").alias("quality"))
    known = known.where("quality IS NOT NULL").where(crc_mod("doc_id", modulus) != remainder)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality IN (0, 1)")
    known = written(known.join(rows.select("doc_id"), "doc_id", "left_semi"), "quality-known")
    totals = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model(np.zeros(N_FEATURES), 0.0, 1.0)
    labelled = rows.join(dealt(known, totals, max_each), "doc_id").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.min("blocks").alias("blocks"),
        F.min("x").alias("x"))  # an id may come in many rows
    labelled = written(labelled, "quality-labelled")
    weights = mean_weights(labelled)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(matrix(batch.column(1)) @ weights)],
                names=["quality", "strength"])

    strengths = labelled.select("quality", "x").mapInArrow(work, "quality int, strength double")
    return Model(weights, cut_of(written(strengths, "quality-strengths"), totals), 1.0)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``described``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(matrix(batch.column(1))))],
                names=["doc_id", "score"])

    return rows.mapInArrow(work, "doc_id long, score double")


def quality(documents: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0,
            threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1: good) of every document."""
    rows = written(described(documents), "quality-features", merge=False)  # whole texts: many tasks
    model = fit_from_labels(rows, labels, modulus, remainder)
    held_out = F.coalesce(crc_mod("doc_id", modulus) == remainder, F.lit(False))
    return score(rows, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
