"""Removal of long byte strings that an earlier document has, by suffix arrays of shards.

A byte goes if a string of LENGTH (50) bytes that covers it also starts in a document with a smaller
id. Equal strings have equal anchors (``anchors``), so a document is a row of segments: runs of
windows with one anchor. The work, over documents dealt into groups by hash and written once as a
table bucketed by group (later steps read a bucket where it lies):

1. Each group posts its distinct anchors by hash range; a range's task sends back to each group
   those that more documents have, and into how many shards each is dealt: as many as its distinct
   segments have SHARD_BYTES, one for nearly all. (40 bits of the hash: a chance match costs work,
   nothing else.)
2. Each group posts the distinct segments of those anchors, with the smallest id that has each: a
   passage in a third of all documents is one row a group. Equal windows have equal hashes, so a
   window's hash says in which of its anchor's shards it lies; a segment is posted as runs of
   neighbouring windows of one shard, so an anchor with any number of segments (a common string of
   31 to 49 bytes between differing words) goes over many ranges, its text with it. A range's task
   merges equal segments, builds the suffix arrays of those that share a shard but differ, by induced
   sorting, and marks by permuted common prefixes which neighbours have LENGTH bytes in common.
   Every window gets the smallest id among its equals.
3. Each group takes the answers, in the order it asked, flags the windows whose smallest id is
   smaller than their document's, and removes what they cover.

Nothing is compared across the bounds of a document, and nothing of the documents' size reaches
the driver.

Defined results: a null text is empty; rows with a null id are kept whole and remove nothing;
rows with one id, equal or not, don't remove from each other; texts shorter than LENGTH are kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.llm.anchors import K, LENGTH, W, prefix_sums, segments, span
from revspark.llm.common import (
    U64,
    give_back,
    id_and_text,
    mix,
    shuffle_partitions,
    slices,
    utf8,
    written,
)
from revspark.llm.packed import pack, unpack
from revspark.llm.suffix_array import common_prefix_at_least, suffix_array
from revspark.scratch import current, shared_path

KEY_BITS = 40
HELD_BYTES = 16 << 20  # text a map task deals out at once
SHARD_BYTES = 1 << 20  # text of one suffix array; its last shard may have as much again
DEALT = 64  # added to the anchor's offset: the segment comes with the key of its shard
HASH_BYTES = 1 << 20  # text hashed at once
EXTRA = LENGTH - 1

RESULT = ("doc_id long, text_key long, n_bytes long, n_removed long, n_spans long, "
          "kept_sha256 string, kept string")


def _bounds(ranges: int) -> np.ndarray:
    return np.array([(i << KEY_BITS) // ranges for i in range(ranges + 1)], np.uint64)


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one behind the other."""
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return data[np.repeat(starts - (stops - sizes), sizes) + np.arange(total)]


def _binary_table(**columns) -> pa.Table:
    kinds = {list: pa.int32()}
    return pa.table({name: pa.array(values, pa.binary() if name == "blob" else kinds[list])
                     for name, values in columns.items()})


def dealt_texts(docs: DataFrame, groups: int) -> DataFrame:
    """Packed documents as a table bucketed by ``grp``: by hash of the id and the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal held
            table = pa.Table.from_batches(held).sort_by("grp")
            held = []
            numbers = table.column("grp").to_numpy()
            first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
            blobs = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(numbers)]):
                part = table.slice(a, b - a).combine_chunks()
                ids = part.column("doc_id")
                data, offs = utf8(part.column("text"))
                blobs.append(pack(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(),
                                  part.column("text_key").to_numpy(), np.diff(offs), data,
                                  level=3))
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers[first]), pa.array(blobs, pa.binary())], names=["grp", "blob"])

        size = 0
        for batch in slices(batches, "text", HELD_BYTES):
            size += batch.get_total_buffer_size()
            held.append(batch)
            if size >= HELD_BYTES:
                yield flush()
                size = 0
        if held:
            yield flush()

    spark = docs.sparkSession
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    packed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"),
                         number.alias("grp")).mapInArrow(work, "grp int, blob binary")
    name = current(spark).table("dealt_texts")
    packed.repartition(groups, "grp").write.bucketBy(groups, "grp").option(
        "path", shared_path(spark, "dealt-texts")).saveAsTable(name)
    return spark.table(name)


class Group:
    """A group's documents, in an order that doesn't depend on how its rows came."""

    def __init__(self, table: pa.Table):
        parts = [unpack(b.as_buffer()) for b in table.column("blob")]
        ids, nulls, keys, sizes = (np.concatenate([p[k] for p in parts]) for k in range(4))
        data = np.concatenate([p[4] for p in parts])
        starts = np.cumsum(sizes) - sizes
        order = np.lexsort((sizes, keys, ids, nulls))
        self.ids, self.nulls, self.keys = ids[order], nulls[order], keys[order]
        self.data = np.concatenate([data[a:a + n] for a, n in zip(
            starts[order].tolist(), sizes[order].tolist())])
        self.offs = np.append(0, np.cumsum(sizes[order]))
        del parts, data
        rows, self.first, self.counts, self.anchor, kmers, self.hashes = segments(
            self.data, self.offs)
        self.rows, self.kmers = rows, kmers >> U64(64 - KEY_BITS)
        self._keep(~self.nulls[rows])

    def _keep(self, mask: np.ndarray) -> None:
        for name in ("rows", "first", "counts", "anchor", "kmers", "hashes"):
            setattr(self, name, getattr(self, name)[mask])

    def _shards(self, shared: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Into how many shards each segment's anchor is dealt; 0: no other document has it."""
        known = np.concatenate([*(k for k, _ in shared), np.zeros(0, np.uint64)])
        shards = np.concatenate([*(n for _, n in shared), np.zeros(0, np.uint32)])
        if not len(known):
            return np.zeros(len(self.kmers), np.int64)
        order = np.argsort(known)
        known, shards = known[order], shards[order].astype(np.int64)
        at = np.searchsorted(known, self.kmers)
        at[at == len(known)] = 0
        return np.where(known[at] == self.kmers, shards[at], 0)

    def _deal(self, shards: np.ndarray) -> None:
        """Put runs of neighbouring windows of one shard in the place of segments whose anchor has
        several. A window's shard is its hash modulo their number."""
        whole, split = np.flatnonzero(shards == 1), np.flatnonzero(shards > 1)
        counts = self.counts[split]
        stops = np.cumsum(counts)
        owner = np.repeat(split, counts)
        inner = np.arange(len(owner)) - np.repeat(stops - counts, counts)
        number = np.empty(len(owner), np.int64)
        step = HASH_BYTES // (LENGTH + W - 1)
        for at in range(0, len(split), step):
            some = split[at:at + step]
            own = slice(int(stops[at] - counts[at]), int(stops[at + len(some) - 1]))
            sizes = self.counts[some] + EXTRA
            starts = np.repeat(np.cumsum(sizes) - sizes, self.counts[some]) + inner[own]
            sums = prefix_sums(_gather(self.data, self.first[some], sizes))
            number[own] = (span(sums, starts, LENGTH) >> U64(1)).astype(np.int64)
        number %= shards[owner]
        new = inner == 0
        new[1:] |= number[1:] != number[:-1]
        runs = np.flatnonzero(new)
        of, at, number = owner[runs], inner[runs], number[runs]
        sizes = np.diff(np.append(runs, len(owner)))
        anchor = self.anchor[of] - at
        first = self.first[of] + at
        hashes = np.empty(len(of), np.uint64)
        for a in range(0, len(of), step):
            own = slice(a, a + step)
            text = sizes[own] + EXTRA
            sums = prefix_sums(_gather(self.data, first[own], text))
            hashes[own] = _segment_hashes(sums, np.cumsum(text) - text, text, sizes[own], anchor[own])
        dealt = mix(self.kmers[of] ^ mix(number.astype(np.uint64) + U64(1))) >> U64(64 - KEY_BITS)
        self.kmers = np.concatenate([self.kmers[whole], dealt])
        self.hashes = np.concatenate([self.hashes[whole], hashes])
        self.rows = np.concatenate([self.rows[whole], self.rows[of]])
        self.first = np.concatenate([self.first[whole], first])
        self.counts = np.concatenate([self.counts[whole], sizes.astype(self.counts.dtype)])
        self.anchor = np.concatenate([self.anchor[whole], anchor + DEALT])

    def select(self, shared: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Keep the segments of shared anchors, as they are dealt into shards; number the distinct
        ones by (shard, hash)."""
        shards = self._shards(shared)
        self._keep(shards > 0)
        self._deal(shards[shards > 0])
        order = np.lexsort((self.hashes, self.kmers))
        k, h = self.kmers[order], self.hashes[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
        self.number = np.empty(len(k), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.distinct = order[new]
        self.least = (np.minimum.reduceat(self.ids[self.rows[order]], np.flatnonzero(new))
                      if len(k) else np.zeros(0, np.int64))

    def cuts(self, ranges: int) -> np.ndarray:
        cuts = np.searchsorted(self.kmers[self.distinct], _bounds(ranges))
        cuts[-1] = len(self.distinct)
        return cuts


def post_anchors(ranges: int):
    def work(table: pa.Table) -> pa.Table:
        group = Group(table)
        order = np.lexsort((group.rows, group.kmers))
        kmers, ids = group.kmers[order], group.ids[group.rows[order]]
        new = np.ones(len(kmers), bool)
        new[1:] = kmers[1:] != kmers[:-1]
        first = np.flatnonzero(new)
        many = np.zeros(len(first), bool)
        if len(first):  # rows are in the order of ids, so more ids show at the ends
            last = np.append(first[1:], len(kmers)) - 1
            many = ids[first] != ids[last]
        sizes = np.diff(np.append(first, len(kmers)))
        n_distinct = np.ones(len(first), np.uint32)
        again = np.repeat(sizes > 1, sizes)
        if again.any():
            k, h = kmers[again], group.hashes[order[again]]
            by_hash = np.lexsort((h, k))
            k, h = k[by_hash], h[by_hash]
            differs = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]))
            n_distinct[sizes > 1] = np.add.reduceat(
                differs, np.flatnonzero(np.append(True, k[1:] != k[:-1])), dtype=np.uint32)
        kmers = kmers[first]
        del group, order, ids
        give_back()
        cuts = np.searchsorted(kmers, _bounds(ranges))
        cuts[-1] = len(kmers)
        pieces = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return _binary_table(
            range=[p[0] for p in pieces], grp=[table.column("grp")[0].as_py()] * len(pieces),
            blob=[pack(kmers[a:b], many[a:b], n_distinct[a:b], ascending=1) for _, a, b in pieces])

    return work


def shared_anchors(table: pa.Table) -> pa.Table:
    """For each group, its anchors that another group or another of its documents has, and into how
    many shards they are dealt."""
    parts = [unpack(b.as_buffer()) for b in table.column("blob")]
    every = np.sort(np.concatenate([p[0] for p in parts]))
    often = np.zeros(len(every), bool)
    often[1:] = every[1:] == every[:-1]
    several = np.unique(np.concatenate([every[often], *(p[0][p[1]] for p in parts)]))
    segments_of, asked = np.zeros(len(several), np.int64), []
    for kmers, _, n_distinct in parts:
        own = np.isin(kmers, several, assume_unique=True)
        at = np.searchsorted(several, kmers[own])
        segments_of[at] += n_distinct[own]
        asked.append(at)
    # As whole segments if one shard takes them, else as windows with their own bytes at worst; small
    # shards, so that ranges get about as much each.
    shards = np.where(segments_of * (LENGTH + W - 1) <= SHARD_BYTES, 1,
                      -(-4 * segments_of * W * LENGTH // SHARD_BYTES)).astype(np.uint32)
    groups, blobs = [], []
    for number, at in zip(table.column("grp").to_pylist(), asked):
        if len(at):
            groups.append(number)
            blobs.append(pack(several[at], shards[at], ascending=1))
    return _binary_table(grp=groups, blob=blobs)


def post_segments(ranges: int):
    def work(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not len(table) or not len(shared):
            return _binary_table(range=[], grp=[], blob=[])
        group = Group(table)
        group.select([tuple(unpack(b.as_buffer())) for b in shared.column("blob")])
        number = table.column("grp")[0].as_py()
        rows, out = [], []
        cuts = group.cuts(ranges)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                own = group.distinct[a:b]
                text = _gather(group.data, group.first[own], group.counts[own] + EXTRA)
                dealt = own[group.anchor[own] >= DEALT]
                out.append(pack(group.counts[own].astype(np.uint8),
                                group.anchor[own].astype(np.uint8), group.least[a:b], text,
                                group.kmers[dealt]))
                rows.append(i)
        del group
        give_back()
        return _binary_table(range=rows, grp=[number] * len(rows), blob=out)

    return work


def window_minima(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, least: np.ndarray
                  ) -> np.ndarray:
    """For every window of all segments, in order: the smallest ``least`` among the segments that
    have the same window. ``text`` holds the segments; suffixes of it are sorted."""
    stops = np.cumsum(counts)
    places = np.repeat(starts - (stops - counts), counts) + np.arange(stops[-1])
    number = np.full(len(text), -1, np.int64)
    number[places] = np.arange(len(places))
    suffixes = suffix_array(text, LENGTH)
    suffixes = suffixes[number[suffixes] >= 0]
    new = np.append(True, ~common_prefix_at_least(text, suffixes, LENGTH))
    first = np.flatnonzero(new)
    windows = number[suffixes]
    of_window = np.repeat(least, counts)
    smallest = np.minimum.reduceat(of_window[windows], first)
    out = np.empty(len(places), np.int64)
    out[windows] = np.repeat(smallest, np.diff(np.append(first, len(windows))))
    return out


def _segment_hashes(sums: np.ndarray, starts: np.ndarray, sizes: np.ndarray, counts: np.ndarray,
                    anchors: np.ndarray) -> np.ndarray:
    """Hashes of segments (text, windows and the anchor's offset), as ``segments`` has them."""
    with np.errstate(over="ignore"):
        return mix(span(sums, starts, sizes) + counts.astype(np.uint64) * U64(W + 1)
                   + anchors.astype(np.uint64))


def _hashes(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, counts: np.ndarray,
            anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of segments that lie side by side in ``text``, and of their anchors."""
    hashes, kmers = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + HASH_BYTES)))
        own = slice(at, end)
        base = starts[at]
        sums = prefix_sums(text[base:starts[end - 1] + sizes[end - 1]])
        hashes[own] = _segment_hashes(sums, starts[own] - base, sizes[own], counts[own], anchors[own])
        kmers[own] = span(sums, starts[own] + anchors[own] - base, K)
        at = end
    return hashes, kmers


def answer_segments(table: pa.Table) -> pa.Table:
    """For each group's segments, as posted: the number of minima (1: one for all windows) and
    the minima."""
    parts = [unpack(b.as_buffer()) for b in table.column("blob")]
    counts, anchors = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (0, 1))
    least, text = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
    dealt = anchors >= DEALT  # their shards' keys are posted; others' are their anchors
    anchors[dealt] -= DEALT
    sizes = counts + EXTRA
    starts = np.cumsum(sizes) - sizes
    hashes, kmers = _hashes(text, starts, sizes, counts, anchors)
    kmers[dealt] = np.concatenate([p[4] for p in parts])
    order = np.lexsort((hashes, kmers))
    k, h = kmers[order], hashes[order]
    new = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]))
    first = np.flatnonzero(new)
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(new) - 1
    own = order[first]  # one of each distinct segment, in the order of anchors
    smallest = np.minimum.reduceat(least[order], first)
    anchor_first = np.append(True, k[first][1:] != k[first][:-1])
    per_anchor = np.diff(np.append(np.flatnonzero(anchor_first), len(own)))
    differ = np.flatnonzero(np.repeat(per_anchor, per_anchor) > 1)

    n_minima = np.ones(len(own), np.int64)
    minima: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    held = np.cumsum(sizes[own[differ]])
    borders = np.flatnonzero(anchor_first[differ])
    while at < len(differ):  # whole shards, small ones together
        base = held[at - 1] if at else 0
        end = int(np.searchsorted(held, base + SHARD_BYTES))
        following = borders[np.searchsorted(borders, max(end, at + 1)):]
        end = int(following[0]) if len(following) else len(differ)
        some = differ[at:end]
        segs = own[some]
        shard = _gather(text, starts[segs], sizes[segs])
        local = np.cumsum(sizes[segs]) - sizes[segs]
        minima.append((some, window_minima(shard, local, counts[segs], smallest[some])))
        at = end
    # One value for a segment whose windows agree.
    values, value_at = [smallest], np.arange(len(own))
    total = len(own)
    for some, found in minima:
        stops = np.cumsum(counts[own[some]])
        begin = stops - counts[own[some]]
        low, high = np.minimum.reduceat(found, begin), np.maximum.reduceat(found, begin)
        smallest[some] = low
        mixed = low != high
        n_minima[some[mixed]] = counts[own[some[mixed]]]
        value_at[some[mixed]] = total + begin[mixed]
        values.append(found)
        total += len(found)
    pool = np.concatenate(values)
    blobs, at = [], 0
    for part in parts:
        mine = number[at:at + len(part[0])]
        at += len(part[0])
        blobs.append(pack(n_minima[mine].astype(np.uint8),
                          _gather(pool, value_at[mine], n_minima[mine])))
    del parts, text, hashes, kmers, order, pool
    give_back()
    return pa.table({"grp": table.column("grp").combine_chunks(),
                     "range": table.column("range").combine_chunks(),
                     "blob": pa.array(blobs, pa.binary())})


def remove(with_text: bool):
    def work(table: pa.Table, shared: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table)
        # +1 where removal begins and -1 where it ends, at one place at most two of either; each
        # document has a place more, for an end at its end.
        change = np.zeros(len(group.data) + len(group.ids), np.int8)
        if len(answers):
            group.select([tuple(unpack(b.as_buffer())) for b in shared.column("blob")])
            found = sorted(zip(answers.column("range").to_pylist(), answers.column("blob")),
                           key=lambda x: x[0])
            parts = [unpack(b.as_buffer()) for _, b in found]
            n_minima = np.concatenate([p[0] for p in parts]).astype(np.int64)
            minima = np.concatenate([p[1] for p in parts])
            if len(n_minima) != len(group.distinct):
                raise ValueError("a group's segments differ from those it posted")
            begin = np.cumsum(n_minima) - n_minima
            ids = group.ids[group.rows]
            uniform = n_minima[group.number] == 1
            gone = uniform & (minima[begin[group.number]] < ids)
            _cover(change, (group.first + group.rows)[gone], group.counts[gone] + EXTRA)
            mixed = np.flatnonzero(~uniform)
            counts = group.counts[mixed]
            owner = np.repeat(mixed, counts)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            gone = minima[begin[group.number[owner]] + inner] < ids[owner]
            _cover(change, (group.first[owner] + group.rows[owner] + inner)[gone], LENGTH)
        removed, spans, hashes, kept = [], [], [], []
        for i, (a, b) in enumerate(zip(group.offs[:-1].tolist(), group.offs[1:].tolist())):
            gone = np.cumsum(change[a + i:b + i], dtype=np.int32) > 0
            text = group.data[a:b]
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            text = (text[~gone] if removed[-1] else text).tobytes()
            hashes.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode("utf-8", "ignore") if with_text else None)
        out = pa.table({
            "doc_id": pa.array(group.ids, mask=group.nulls), "text_key": pa.array(group.keys),
            "n_bytes": pa.array(np.diff(group.offs)), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(hashes, pa.string()),
            "kept": pa.array(kept, pa.string())})
        del group, change
        give_back()
        return out

    return work


def _cover(change: np.ndarray, starts: np.ndarray, sizes) -> None:
    np.add.at(change, starts, 1)
    np.add.at(change, starts + sizes, -1)


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), n_bytes, n_removed, n_spans, kept_sha256 of every
    row; with ``with_text`` also kept, the remaining bytes as text (what is left of a character that
    a cut parts goes too)."""
    groups = shuffle_partitions(df.sparkSession)
    ranges = 2 * groups
    texts = dealt_texts(id_and_text(df, id_col, text_col), groups)
    posted = "range int, grp int, blob binary"
    anchors = texts.groupBy("grp").applyInArrow(post_anchors(ranges), posted)
    shared = written(anchors.groupBy("range").applyInArrow(
        shared_anchors, "grp int, blob binary"), "shared-anchors")
    asked = texts.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(
        post_segments(ranges), posted)
    answers = written(asked.groupBy("range").applyInArrow(
        answer_segments, "grp int, range int, blob binary"), "segment-answers")
    # The removal needs both small tables; they come in one, told apart by `range`.
    both = answers.unionByName(shared.withColumn("range", F.lit(-1)))
    work = remove(with_text)

    def finish(table: pa.Table, side: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({f.split()[0]: pa.array([], t) for f, t in zip(
                RESULT.split(", "), (*(pa.int64(),) * 5, pa.string(), pa.string()))})
        is_answer = pa.array(side.column("range").to_numpy() >= 0)
        return work(table, side.filter(pa.array(~is_answer.to_numpy(False))),
                    side.filter(is_answer))

    out = texts.groupBy("grp").cogroup(both.groupBy("grp")).applyInArrow(finish, RESULT)
    return out if with_text else out.drop("kept")
