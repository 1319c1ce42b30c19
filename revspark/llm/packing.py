"""Packing documents into sequences of a fixed number of tokens by shortest-pack-first over the
histogram of lengths.

1. One narrow map: a document's ids (an end id appended) are cut into full pieces of ``size`` ids
   and a rest; every piece keeps its place, length and crc32. No ids are shuffled.
2. The histogram of piece lengths: at most ``size`` numbers, whatever the input, to the driver.
3. ``pack_histogram`` places lengths longest first, each into the shortest pack that is still
   open, splitting pattern counts: at most two patterns for each length.
4. Pieces get a rank within their length and the patterns' slots are ranges of ranks, so a piece
   finds its sequence by rank. Ranks come from small (length, bucket) counts and a window within
   each bucket of ids, so a length held by a third of all pieces is split over all buckets.

Defined results: a null or empty text is a document of the end id alone; repeated rows are packed
each on its own; null ids are packed too; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revspark.llm.common import crc32_ids, id_and_text, slices, written
from revspark.llm.token_ids import encoder

SIZE = 1024
ROWS_PER_BUCKET = 200_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(df: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """The pieces of every document: full ones of ``size`` ids, and the rest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in slices(batches, "text", keep=True):
            ids, counts = encode(batch.column(1).to_pylist())
            docs, starts, lengths, sums, totals = [], [], [], [], []
            at = 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                own = np.append(ids[at:at + n], np.int32(end_id))
                at += n
                for start in range(0, n + 1, size):
                    piece = own[start:start + size]
                    docs.append(doc)
                    starts.append(start)
                    lengths.append(len(piece))
                    sums.append(crc32_ids(piece))
                    totals.append(n + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (docs, starts, lengths, sums, totals)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return id_and_text(df, id_col, text_col).mapInArrow(work, PIECES)


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (the piece lengths of one sequence) and how many sequences follow each.

    Longest lengths first; pieces go into the shortest open pack with room for them, splitting
    its pattern's count where fewer pieces than packs are left. Pieces that no open pack takes
    start packs of their own length, as many to a pack as fit.
    """
    packs: list[tuple[int, tuple[int, ...], int]] = []  # filled, lengths, sequences
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, placed = counts[length], []
        for pack in sorted((p for p in packs if p[0] + length <= size), key=lambda p: p[0]):
            n = min(left, pack[2])
            if not n:
                break
            left -= n
            packs.remove(pack)
            if pack[2] > n:
                packs.append((pack[0], pack[1], pack[2] - n))
            placed.append((pack[0] + length, (*pack[1], length), n))
        many = size // length
        for each, n in ((many, left // many), (left % many, 1)):
            if each and n:
                placed.append((each * length, (length,) * each, n))
        packs += placed
    return [(lengths, n) for _, lengths, n in packs]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in rank order: the piece of rank r
    at or after a row's first rank lies in sequence ``first sequence + r - first rank``."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            out.setdefault(length, []).append((rank, sequence, offset))
            ranks[length] = rank + n
            offset += length
        sequence += n
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def ranked(pieces: DataFrame, total: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``pieces`` plus ``rank``: from 0 within each length, without a gap.

    Buckets of about ``rows_per_bucket`` pieces by id hash: a rank within (length, bucket) plus
    the number of that length's pieces in the buckets before.
    """
    buckets = max(1, -(-total // rows_per_bucket))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    return (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("ahead"))
        .drop("bucket", "ahead")
    )


def pack(df: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = written(cut(df, tokenizer, end_id, size, id_col, text_col), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    places = slots(pack_histogram(histogram, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequences, offsets = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                rows = places[int(length)]
                rows = rows[np.searchsorted(rows[:, 0], ranks[own], side="right") - 1]
                sequences[own] = rows[:, 1] + ranks[own] - rows[:, 0]
                offsets[own] = rows[:, 2]
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequences), pa.array(offsets)],
                names=[*kept.schema.names, "sequence_id", "offset"])

    columns = [c.split()[0] for c in PIECES.split(", ")]
    return ranked(pieces, sum(histogram.values())).select(*columns, "rank").mapInArrow(
        place, f"{PIECES}, sequence_id long, offset long")
