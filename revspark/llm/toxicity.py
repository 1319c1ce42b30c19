"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the presence of hashed words and word beginnings is trained in numpy
from confirmed toxic examples and unlabelled text. The risk is corrected by the class prior pi:

    pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))

with the logistic loss; where the second part is negative (the classifier has begun to fit
positive examples hidden in the unlabelled text), the step goes the other way.

Training reads a bounded sample, chosen by id hash: ``MAX_POSITIVE`` confirmed examples and
``MAX_UNLABELLED`` documents of any kind, neither from held-out rows. A feature is a candidate if it
is significantly more frequent in the confirmed examples than in other text (``MIN_EVIDENCE``, a
likelihood ratio); of the candidates the ``MAX_FEATURES`` with the highest ratio of frequencies are
the model's, and their weights decide. What reaches the driver is bounded too: these features and,
per sampled document, which of them it has. The prior is the toxic share of all labelled rows that
are not held out. Scoring is one
narrow map over all documents and whole texts.

Defined results: a null text is empty and scores the classifier's bias; a null id is not held
out; several labels of one id count as the largest; without confirmed examples every score is 0;
repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import (
    BYTE_VALUES,
    LOWER,
    U64,
    crc_mod,
    id_and_text,
    mix,
    slices,
    span_hashes,
    utf8,
    word_spans,
)

MAX_POSITIVE = 3000
MAX_UNLABELLED = 9000
MAX_FEATURES = 8192
MIN_EVIDENCE = 20.0  # G of a feature's counts in toxic and in other text; by chance one in 100,000
BEGINNINGS = (4, 5, 6)  # bytes
THRESHOLD = 0.7
STEPS, RATE, PENALTY = 4000, 0.05, 3e-5

# Words: letters and digits of ASCII, and all bytes of other characters.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature) of every word and word beginning of all rows, repeats included."""
    starts, ends, before = word_spans(data, offs, WORD_BYTES)
    rows = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(before))
    values = BYTE_VALUES[LOWER[data]]
    all_rows, found = [rows], [span_hashes(values, starts, ends)]
    for size in BEGINNINGS:
        long = np.flatnonzero(ends - starts > size)
        hashes = span_hashes(values, starts[long], starts[long] + size)
        all_rows.append(rows[long])
        found.append(mix(hashes + U64(size)))
    return np.concatenate(all_rows), np.concatenate(found)


class Selected:
    """Looks up which of the selected features rows have."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> U64(44)).astype(np.int64)] = True

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature number), each pair once."""
        rows, found = features(data, offs)
        likely = self.bits[(found >> U64(44)).astype(np.int64)]
        rows, found = rows[likely], found[likely]
        at = np.searchsorted(self.keys, found)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == found if len(self.keys) else np.zeros(0, bool)
        pairs = np.unique(rows[hit].astype(np.int64) * (len(self.keys) + 1) + at[hit])
        return pairs // (len(self.keys) + 1), pairs % (len(self.keys) + 1)


@dataclass
class Model:
    keys: np.ndarray  # sorted features
    weights: np.ndarray
    bias: float

    def scorer(self):
        selected = Selected(self.keys)

        def score(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
            rows, at = selected(data, offs)
            sums = np.bincount(rows, self.weights[at], len(offs) - 1) if len(rows) else 0.0
            return 1 / (1 + np.exp(-np.clip(self.bias + np.zeros(len(offs) - 1) + sums, -700, 700)))

        return score


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int,
               prior: float, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY
               ) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier by the non-negative risk, with Adam steps.

    The two lists hold each example's feature numbers.
    """
    rows = [*positive, *unlabelled]
    example = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    is_positive = np.arange(len(rows)) < len(positive)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        margin = theta[-1] + np.bincount(example, theta[feature], len(rows))
        p = sigmoid(margin)
        minus_loss = np.logaddexp(0, margin)  # loss if the label were -1
        negative_risk = minus_loss[~is_positive].mean() if len(unlabelled) else 0.0
        negative_risk -= prior * minus_loss[is_positive].mean() if len(positive) else 0.0
        # d loss(+1) / d margin = p - 1; d loss(-1) / d margin = p
        plus = np.where(is_positive, prior * (p - 1) / n_p, 0.0)
        minus = np.where(is_positive, -prior * p / n_p, p / n_u)
        slope = plus + minus if negative_risk >= 0 else -minus
        gradient = np.append(np.bincount(feature, slope[example], n_features), slope.sum())
        gradient[:-1] += penalty * theta[:-1]
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def told_apart(p: Column, u: Column, n_p: float, n_u: float, prior: float
               ) -> tuple[Column, Column]:
    """How many times as frequent a feature is in toxic as in other text, and the evidence for it (G,
    the logarithm of a likelihood ratio, doubled). The unlabelled text is a mixture; without its
    share of toxic text it shows the rest. Half an example is added to either side."""
    size = n_u * (1 - prior)
    rest = F.greatest(F.lit(0.0), u - F.lit(prior * n_u / n_p) * p) + F.lit(0.5)
    own = p + F.lit(0.5)
    together = (own + rest) / F.lit(n_p + size + 1)
    part = lambda x, n: x * F.log(x / (F.lit(n) * together))
    ratio = (own / F.lit(n_p + 0.5)) / (rest / F.lit(size + 0.5))
    return ratio, F.lit(2.0) * (part(own, n_p + 0.5) + part(rest, size + 0.5))


def fit(documents: DataFrame, confirmed: DataFrame, prior: float,
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Train from ``confirmed`` ids (doc_id) and text of ``documents`` (doc_id, text)."""
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -700.0)
    if not 0 < prior < 1:
        return nothing
    order = F.xxhash64("doc_id")

    def least(df: DataFrame, n: int) -> DataFrame:
        return df.select("doc_id").distinct().orderBy(order, "doc_id").limit(n)

    ids = documents.where(F.col("doc_id").isNotNull()).select("doc_id")
    some = least(ids.join(confirmed, "doc_id", "left_semi"), max_positive).collect()
    if not some:
        return nothing
    others = least(ids, max_unlabelled).collect()
    positive, unlabelled = {r["doc_id"] for r in some}, {r["doc_id"] for r in others}
    spark = documents.sparkSession
    wanted = spark.createDataFrame([(i,) for i in positive | unlabelled], "doc_id long")
    # At most max_positive + max_unlabelled ids: broadcasting them is bounded.
    sample = documents.join(F.broadcast(wanted), "doc_id")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Features of a task's examples: in how many confirmed ones and in how many of the
        unlabelled sample each is."""
        for batch in slices(batches, "text"):
            rows, found = features(*utf8(batch.column(1)))
            order = np.lexsort((found, rows))
            rows, found = rows[order], found[order]
            new = np.ones(len(rows), bool)
            new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
            keys, at = np.unique(found[new], return_inverse=True)
            ids = batch.column(0).to_pylist()
            counts = [np.bincount(at, np.array([i in some for i in ids], float)[rows[new]], len(keys))
                      for some in (positive, unlabelled)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), *[pa.array(c) for c in counts]],
                names=["feature", "p", "u"])

    sizes = [max(1.0, float(n)) for n in (len(positive), len(unlabelled))]
    counted = sample.select("doc_id", "text").mapInArrow(
        shared, "feature long, p double, u double").groupBy("feature").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u"))
    ratio, evidence = told_apart(F.col("p"), F.col("u"), *sizes, prior)
    telling = counted.where(F.col("p") >= 2).select("feature", ratio.alias("r"), evidence.alias("g"))
    chosen = telling.where((F.col("r") > 1) & (F.col("g") >= MIN_EVIDENCE)).orderBy(
        F.desc("r"), "feature").limit(MAX_FEATURES).collect()
    keys = np.sort(np.array([r["feature"] for r in chosen], np.int64).view(np.uint64))

    def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        selected = Selected(keys)
        for batch in slices(batches, "text"):
            rows, at = selected(*utf8(batch.column(1)))
            sizes = np.bincount(rows, minlength=batch.num_rows)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "at"])

    held = sample.select("doc_id", "text").mapInArrow(which, "doc_id long, at array<int>")
    held = held.groupBy("doc_id").agg(F.min("at").alias("at"))  # an id may come in many rows
    table = held.toArrow().combine_chunks()
    lists = table.column("at").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    values, offs = lists.values.to_numpy(), lists.offsets.to_numpy()
    examples = {i: values[a:b].astype(np.int64) for i, a, b in zip(
        table.column("doc_id").to_pylist(), offs, offs[1:])}
    of = lambda ids: [examples[i] for i in sorted(ids) if i in examples]
    p, u = of(positive), of(unlabelled)
    weights, bias = train_nnpu(p, u, len(keys), prior)
    return Model(keys, weights, bias)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """doc_id and score of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scorer(*utf8(batch.column(1))))],
                names=["doc_id", "score"])

    return id_and_text(documents, id_col, text_col).mapInArrow(work, "doc_id long, score double")


def below(documents: DataFrame, model: Model, threshold: float = THRESHOLD,
          text_col: str = "text") -> DataFrame:
    """The rows of ``documents``, with all their columns, that score less than ``threshold``."""
    place = documents.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                texts = part.column(place).cast(pa.string()).fill_null("")
                keep = scorer(*utf8(texts)) < threshold
                yield part.filter(pa.array(keep))

    # By number, as a name may hold a dot.
    numbered = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    return numbered.mapInArrow(work, numbered.schema).toDF(*documents.columns)


def fit_from_labels(documents: DataFrame, labels: DataFrame, modulus: int = 3,
                    remainder: int = 1) -> Model:
    """Train on rows whose crc32(doc_id) mod ``modulus`` isn't ``remainder``."""
    kept = lambda df: df.where(crc_mod("doc_id", modulus) != remainder)
    known = kept(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"))
    known = known.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg("toxic").alias("p")).first()["p"] or 0.0
    return fit(kept(id_and_text(documents)), known.where("toxic = 1"), float(prior))


def toxicity(documents: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1,
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1: toxic) of every document."""
    model = fit_from_labels(documents, labels, modulus, remainder)
    held_out = F.coalesce(crc_mod("doc_id", modulus) == remainder, F.lit(False))
    return score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
