"""Token ids in Re-Pair compressed shards, and random-access reading of them.

Re-Pair: the most frequent pairs of neighbouring symbols become new symbols (nonterminals), again
and again, until no pair repeats often enough to pay for its rule. A shard's file block holds the rules (left, right), the expansion length of every
rule, the compressed sequence, and the documents' token counts, so any token range is decoded by
finding its first symbol through the running expansion lengths and expanding only the symbols
that cover it.

Block layout (little-endian): magic ``RPR2``; uint32 counts of terminals, rules, symbols and
documents; rules as two uint32 columns; expansion lengths uint32; symbols, uint16 or uint32 (each of
these uint32 columns as its low uint16 halves, then its high ones, which nearly vanish when
deflated); documents' ids int64 with a null bitmap, token counts uint32. The part behind the magic
is deflated. Blocks are rows of a Parquet table (part, block, start within the part, tokens,
payload), written by Spark's committer: a lost executor leaves no partial block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revspark.llm.common import crc32_ids, id_and_text, shuffle_partitions, slices, written
from revspark.llm.token_ids import encoder

MAGIC = b"RPR2"
SHARD_TOKENS = 1 << 20
MIN_COUNT = 4  # a rule's 12 bytes cost as much as three symbols

BLOCKS = "part int, block int, start long, tokens long, payload binary"


def counted_pairs(seq: np.ndarray, live: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (left << 32 | right, sorted) of the pairs at the ``live`` places, how often each is
    there without overlap, and the places, pair by pair. In a run of one symbol every second pair
    from the left counts."""
    equal = np.flatnonzero(seq[:-1] == seq[1:])
    starts = np.append(True, np.diff(equal) != 1)[:len(equal)]
    within = np.arange(len(equal))
    within -= np.maximum.accumulate(np.where(starts, within, 0))
    live = live.copy()
    live[equal[within % 2 == 1]] = False
    places = np.flatnonzero(live)
    left, right = seq[places], seq[places + 1]
    left, right = left.astype(np.uint64), right.astype(np.uint64)
    place_bits = len(seq).bit_length()
    bits = int(max(left.max(initial=0), right.max(initial=0))).bit_length()
    if 2 * bits + place_bits <= 64:  # one sort of numbers that hold pair and place
        key = (left << np.uint64(bits) | right) << np.uint64(place_bits)
        key |= places.astype(np.uint64)
        key.sort()
        places = (key & np.uint64((1 << place_bits) - 1)).astype(np.int64)
        key >>= np.uint64(place_bits)
    else:
        key = left << np.uint64(32) | right
        order = np.argsort(key, kind="stable")
        key, places, bits = key[order], places[order], 32
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    counts = np.diff(np.append(first, len(key)))
    key = key[first]
    low = np.uint64((1 << bits) - 1)
    return (key >> np.uint64(bits)) << np.uint64(32) | key & low, counts, places


def compress(ids: np.ndarray, terminals: int, max_rounds: int | None = None,
             min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules (n, 2), expansion lengths of the rules).

    A round replaces each pair where it is more frequent than both pairs that overlap it (of
    equally frequent ones the larger code goes first), so the most frequent pair of all goes
    everywhere. Rounds end (``max_rounds`` None) when no pair without a rule is there
    ``min_count`` times and no pair with a rule is left. Between full counts only places are
    counted whose pair was frequent or has a new symbol: other pairs don't become more.
    """
    seq = ids.astype(np.uint32)
    rules = np.zeros((0, 2), np.uint32)
    lengths = np.zeros(0, np.uint32)
    codes = symbols = np.zeros(0, np.uint64)  # of the rules, in the order of codes
    live, full, rounds = np.ones(max(0, len(seq) - 1), bool), True, 0
    while len(seq) > 1 and (max_rounds is None or rounds < max_rounds):
        pairs, counts, places = counted_pairs(seq, live)
        at = np.searchsorted(codes, pairs)
        at[at == len(codes)] = 0
        ruled = codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)
        frequent = ruled | (counts >= min_count)
        if not frequent.any():
            if full:
                break
            live, full = np.ones(len(seq) - 1, bool), True
            continue
        rounds += 1
        places = places[np.repeat(frequent, counts)]
        pairs, counts, ruled, at = (x[frequent] for x in (pairs, counts, ruled, at))
        which = np.repeat(np.arange(len(pairs)), counts)
        rank = np.empty(len(pairs), np.int32)
        rank[np.argsort(counts, kind="stable")] = np.arange(1, len(pairs) + 1)
        own, weight = rank[which], np.zeros(len(seq) + 1, np.int32)
        weight[places + 1] = own
        taken = (own > weight[places]) & (own > weight[places + 2])
        pays = ruled | (np.bincount(which[taken], minlength=len(pairs)) >= min_count)
        taken &= pays[which]
        live = np.zeros(len(seq), bool)
        live[places] = True
        places, which = places[taken], which[taken]

        fresh = pays & ~ruled
        number = np.zeros(len(pairs), np.uint64)
        number[ruled] = symbols[at[ruled]]
        number[fresh] = terminals + len(rules) + np.arange(fresh.sum())
        new = np.stack([pairs[fresh] >> np.uint64(32), pairs[fresh] & np.uint64(0xFFFFFFFF)], 1)
        new = new.astype(np.uint32)
        lengths = np.concatenate([lengths, _sizes(new, lengths, terminals).sum(1, dtype=np.uint32)])
        rules = np.concatenate([rules, new])
        codes = np.concatenate([codes, pairs[fresh]])
        symbols = np.concatenate([symbols, number[fresh]])
        order = np.argsort(codes, kind="stable")  # two sorted runs
        codes, symbols = codes[order], symbols[order]

        seq[places] = number[which]
        live[places] = True
        live[np.maximum(places - 1, 0)] = True
        keep = np.ones(len(seq), bool)
        keep[places + 1] = False
        seq, live, full = seq[keep], live[keep][:-1], False
    return seq, rules, lengths


def _halves(column: np.ndarray) -> np.ndarray:
    """Low halves of all numbers, then high halves: these are nearly all alike."""
    return np.ascontiguousarray(column.astype("<u4")).view("<u2").reshape(-1, 2).T


def _sizes(symbols: np.ndarray, lengths: np.ndarray, terminals: int) -> np.ndarray:
    """How many ids each symbol stands for."""
    out = np.ones(symbols.shape, np.int64)
    nonterminal = symbols >= terminals
    out[nonterminal] = lengths[symbols[nonterminal] - terminals]
    return out


def _by_levels(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, terminals: int
               ) -> np.ndarray:
    """The ids that ``symbols`` stand for: all nonterminals are expanded one level at a time, each
    at its place in the result."""
    sizes = _sizes(symbols, lengths, terminals)
    place = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint32)
    symbols = symbols.astype(np.uint32)
    while True:
        nonterminal = symbols >= terminals
        out[place[~nonterminal]] = symbols[~nonterminal]
        if not nonterminal.any():
            return out
        pairs, place = rules[symbols[nonterminal] - terminals], place[nonterminal]
        place = np.concatenate([place, place + _sizes(pairs[:, 0], lengths, terminals)])
        symbols = np.concatenate([pairs[:, 0], pairs[:, 1]])


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, terminals: int
           ) -> np.ndarray:
    """The ids that ``symbols`` stand for. Of many symbols each rule is expanded once, and its ids are
    copied to wherever it stands."""
    if len(symbols) <= 2 * len(rules):
        return _by_levels(symbols, rules, lengths, terminals)
    pool = np.concatenate([np.arange(terminals, dtype=np.uint32), _by_levels(
        np.arange(terminals, terminals + len(rules)), rules, lengths, terminals)])
    first = np.cumsum(lengths, dtype=np.int64) - lengths + terminals
    begin, sizes = symbols.astype(np.int64), _sizes(symbols, lengths, terminals)
    nonterminal = begin >= terminals
    begin[nonterminal] = first[begin[nonterminal] - terminals]
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return pool[np.repeat(begin - (stops - sizes), sizes) + np.arange(total)]


class Block:
    """A shard's block, readable at any token."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token block")
        raw = memoryview(zlib.decompress(memoryview(payload)[4:]))
        self.terminals, n_rules, n_symbols, n_docs = np.frombuffer(raw, "<u4", 4).tolist()
        at = 16

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        def halves(n: int) -> np.ndarray:
            return np.ascontiguousarray(take("<u2", 2 * n).reshape(2, n).T).view("<u4").reshape(n)

        self.rules = np.stack([halves(n_rules), halves(n_rules)], 1)
        self.lengths = halves(n_rules)
        wide = self.terminals + n_rules > 1 << 16
        self.symbols = halves(n_symbols) if wide else take("<u2", n_symbols)
        self.doc_ids = take("<i8", n_docs)
        self.doc_nulls = take("u1", n_docs).astype(bool)
        self.doc_tokens = take("<u4", n_docs).astype(np.int64)
        self.ends = np.cumsum(_sizes(self.symbols, self.lengths, self.terminals))

    @staticmethod
    def pack(ids: np.ndarray, docs: list, counts: np.ndarray, terminals: int) -> bytes:
        symbols, rules, lengths = compress(ids, terminals)
        wide = terminals + len(rules) > 1 << 16
        parts = [
            np.array([terminals, len(rules), len(symbols), len(docs)], "<u4"),
            _halves(rules[:, 0]), _halves(rules[:, 1]), _halves(lengths),
            _halves(symbols) if wide else symbols.astype("<u2"),
            np.array([0 if d is None else d for d in docs], "<i8"),
            np.array([d is None for d in docs], "u1"), np.asarray(counts).astype("<u4"),
        ]
        return MAGIC + zlib.compress(b"".join(p.tobytes() for p in parts), 1)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, expanding only the symbols that cover them."""
        a = int(np.searchsorted(self.ends, start, side="right"))
        b = int(np.searchsorted(self.ends, stop, side="left")) + 1
        if start >= stop:
            return np.zeros(0, np.uint32)
        before = int(self.ends[a - 1]) if a else 0
        ids = expand(self.symbols[a:b], self.rules, self.lengths, self.terminals)
        return ids[start - before: stop - before]


def write_blocks(df: DataFrame, tokenizer: str, end_id: int, terminals: int,
                 id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """All documents' ids (``end_id`` behind each) in ascending id order, as blocks.

    Range partitions by id (null ids first; rows of one id by their text's hash, then its text)
    are the parts; a shard closes at ``shard_tokens`` tokens or the part's end, so a part of any
    size needs one shard's memory.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        ids, docs, counts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, start, ids, docs, counts, held
            payload = Block.pack(np.concatenate(ids), docs, np.array(counts), terminals)
            row = [[part], [block], [start], [held], [payload]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            out = pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)],
                names=["part", "block", "start", "tokens", "payload"])
            block, start = block + 1, start + held
            ids, docs, counts, held = [], [], [], 0
            return out

        for batch in slices(batches, "text", keep=True):
            found, sizes = encode(batch.column(1).to_pylist())
            stops = np.cumsum(sizes)
            ids.append(np.insert(found, stops, end_id).astype(np.uint32))
            docs += batch.column(0).to_pylist()
            counts += (sizes + 1).tolist()
            held += len(ids[-1])
            if held >= shard_tokens:
                yield flush()
        if held:
            yield flush()

    parts = shuffle_partitions(df.sparkSession)
    ordered = (
        id_and_text(df, id_col, text_col)
        # Rows of one id, or of none, are dealt by their text.
        .repartitionByRange(parts, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    return written(ordered.mapInArrow(work, BLOCKS), "token-blocks", merge=False)


def read_blocks(blocks: DataFrame) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32, read from blocks.

    Parts are few (one per write task): their totals' running sum is the only global step, and
    its table, 16 bytes a part, is what is broadcast.
    """
    totals = blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(payload.as_buffer().to_pybytes())
                stops = np.cumsum(block.doc_tokens)
                starts = stops - block.doc_tokens
                ids = block.tokens(0, int(stops[-1]))
                sums = [crc32_ids(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, mask=block.doc_nulls), pa.array(starts + first),
                     pa.array(block.doc_tokens), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("start") + F.col("part_start")).alias("first"), "payload")
    return placed.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")
