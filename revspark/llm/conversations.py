"""Conversation structure repair: faults of every turn, the cheapest edits that mend a
conversation's role order, and the repaired turns.

The edits are found by ``hirschberg`` from one byte a row. Spark orders the rows, finds the faults and
brings edits and texts together; a conversation of any length, and any number of equal rows, is
split over tasks until its bytes meet:

1. Equal rows (conversation, turn, role, SHA-256 of role and text) are counted by a partial
   aggregate, then dealt by range of these columns and sorted: a long conversation goes over as many
   tasks as its rows need. The texts stay behind. The written order numbers all rows.
2. A row is a duplicate unless its number is the least of its (conversation, digest); the least
   numbers come from a partial aggregate and are joined on the number, which no row shares.
3. The rows of a conversation in one range become a piece: their bytes in order, their turns' least,
   greatest and number. Pieces of a conversation meet in one task: a byte a row, no more than the
   audit that is returned in one cell. Each piece gets its slice of the audit.
4. The texts are dealt by conversation, sorted with the slices in front of their piece's rows, and
   streamed: a task holds one batch of rows and one slice, whatever a conversation's length.
   (A hash over a whole conversation is a sequential thing, so its texts pass one task.)

Rows: ``conv_id``, ``turn``, ``role``, ``text`` and how many ``copies`` of the row there are (0: only
the conversation's id counts; without that column each row counts once). Order: turn (nulls
first), then role, then the digest. Defined results: a null role or text is one space, so its row
has no known initial, or is blank; null conv_ids are one conversation; null turns don't count in
gaps. An empty role has no initial and can't be kept. Repeated rows are duplicates of their first.
Extra columns aren't read; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import give_back, shuffle_partitions, written
from revspark.llm.hirschberg import (
    BLANK,
    CLEAN,
    DELETE,
    DUPLICATE,
    FIRST_CODE,
    INITIALS,
    INSERT,
    NOTHING,
    REROLE,
    TRUNCATED,
    USER,
    added,
    kept,
    repair,
)

# ---- fixed values: the damage, white space, sentence ends and legal neighbours -----------------
DAMAGE_KINDS = 20
DROPPED, EMPTIED, UNSTOPPED, REPEATED, MADE_USER = range(5)
WHITE_SPACE = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
LEGAL = ("su", "ua", "au")
NEXT_ROLE = ("user", "assistant")
# ------------------------------------------------------------------------------------------------
ORDER = ("conv_id", "turn", "role", "digest")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDITS = (", ".join(["conv_id long", *[f"{c} long" for c in COUNTS],
                     "audit string, repaired_sha256 string"]))
TURNS = "conv_id long, place long, edit string, role string, text string"
SHORT = 64  # rows of the conversations whose audits a worker remembers


def damaged(df: DataFrame) -> DataFrame:
    """Conversation rows damaged by the crc32 of ``conv_id:turn``: dropped, emptied, without
    sentence ends, repeated, or given to the user."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary"))
    rows = df.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"),
                     F.pmod(kind, F.lit(DAMAGE_KINDS)).alias("kind"))
    is_ = lambda k: F.col("kind") == k
    text = F.when(is_(EMPTIED), F.lit("")).when(
        is_(UNSTOPPED), F.translate("text", "".join(STOPS), "")).otherwise(F.col("text"))
    role = F.when(is_(MADE_USER), F.lit(NEXT_ROLE[0])).otherwise(F.col("role"))
    copies = F.when(is_(DROPPED), 0).when(is_(REPEATED), 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       copies.alias("copies"))


def _prepared(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies and digest, whatever other columns there are."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copies = F.col("copies") if "copies" in df.columns else F.lit(1)
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"),
                     F.col("turn").cast("long").alias("turn"), text("role"), text("text"),
                     copies.cast("long").alias("copies"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(whole.cast("binary"), 256)))


def _letter(initial: Column, fault: Column) -> Column:
    return F.char(F.lit(FIRST_CODE) + initial * F.lit(4) + fault)


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows in order, numbered, with the number of their copies and what their text shows."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    last = F.substring(trimmed, -1, 1)
    first = F.substring("role", 1, 1)
    initial = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        initial = F.when(first == letter, F.lit(i)).otherwise(initial)
    fault = F.when(last == "", BLANK).when(last.isin(*STOPS), CLEAN).otherwise(TRUNCATED)
    seen = rows.select(*ORDER, initial.alias("initial"), fault.alias("fault"), "copies")
    distinct = seen.groupBy(*ORDER, "initial", "fault").agg(F.sum("copies").alias("copies"))
    parts = shuffle_partitions(rows.sparkSession)
    in_order = distinct.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
    return written(in_order.withColumns({
        "part": F.spark_partition_id(), "number": F.monotonically_increasing_id()}),
        "conversation-rows", merge=False)


def _pieces(ordered: DataFrame) -> DataFrame:
    """The rows of a conversation in one range: ``codes``, a byte a row, and the first row's key."""
    there = ordered.where("copies > 0")
    firsts = there.groupBy("conv_id", "digest").agg(F.min("number").alias("number"))
    firsts = firsts.select("number", F.lit(True).alias("first"))
    rows = ordered.join(firsts, "number", "left")
    blank = F.col("fault") == BLANK
    fault = F.when(blank | F.col("first"), F.col("fault")).otherwise(DUPLICATE)
    again = F.when(blank, BLANK).otherwise(DUPLICATE)
    codes = F.when(F.col("copies") == 0, F.lit("")).otherwise(F.concat(
        _letter(F.col("initial"), fault),
        F.repeat(_letter(F.col("initial"), again), F.col("copies").cast("int") - 1)))
    turn = F.when(F.col("copies") > 0, F.col("turn"))
    head = F.struct("number", "turn", "role", "digest")
    pieces = rows.withColumn("codes", codes).groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("number", "codes"))).alias("rows"),
        F.min(head).alias("head"), F.min(turn).alias("least"), F.max(turn).alias("greatest"),
        F.size(F.collect_set(turn)).cast("long").alias("turns"))
    joined = F.array_join(F.col("rows.codes"), "").alias("codes")
    return pieces.select("conv_id", "part", "head.turn", "head.role", "head.digest", "least",
                         "greatest", "turns", joined)


_SLICE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                    ("digest", pa.binary()), ("kind", pa.int32()), ("copies", pa.int64()),
                    ("text", pa.string()), ("first", pa.bool_()),
                    *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())])
_SLICE_DDL = ("conv_id long, turn long, role string, digest binary, kind int, copies long, "
              "text string, first boolean, " + ", ".join(f"{c} long" for c in COUNTS)
              + ", audit string")


def illegal_neighbours(codes: bytes) -> int:
    initials = (np.frombuffer(codes, np.uint8) - FIRST_CODE) // 4
    legal = np.zeros((4, 4), bool)
    for a, b in LEGAL:
        legal[INITIALS.index(a), INITIALS.index(b)] = True
    return int((~legal[initials[:-1], initials[1:]]).sum())


def _judged(codes: bytes) -> tuple[tuple[int, ...], str]:
    """blank, duplicate, truncated, illegal, cost; audit."""
    faults = np.bincount((np.frombuffer(codes, np.uint8) - FIRST_CODE) % 4, minlength=4).tolist()
    cost, audit = repair(codes)
    counts = (faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal_neighbours(codes), cost)
    return counts, audit


_short_judged = lru_cache(maxsize=50_000)(_judged)


def _with_slices(pieces: list[dict]) -> list[dict]:
    """The pieces of one conversation, each with its slice of the audit; the first also carries what
    is counted over the whole."""
    codes = "".join(p["codes"] for p in pieces).encode()
    counts, audit = (_short_judged if len(codes) <= SHORT else _judged)(codes)
    gaps, before = 0, None
    known = [p for p in pieces if p["least"] is not None]
    if known:
        gaps = known[-1]["greatest"] - known[0]["least"] + 1
        for p in known:
            gaps -= p["turns"] - (p["least"] == before)
            before = p["greatest"]
    own = np.flatnonzero(np.frombuffer(audit.encode(), np.uint8) != ord(INSERT)) + 1
    out, start, rows = [], 0, 0
    for i, p in enumerate(pieces):
        rows += len(p["codes"])
        stop = int(own[rows - 1]) if rows else 0
        if i == len(pieces) - 1:
            stop = len(audit)
        row = {"conv_id": p["conv_id"], "turn": p["turn"], "role": p["role"],
               "digest": p["digest"], "kind": 0, "text": audit[start:stop], "first": i == 0}
        if i == 0:
            row.update(zip(COUNTS, (gaps, *counts)), audit=audit)
        out.append(row)
        start = stop
    return out


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != held[0]["conv_id"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _slices(pieces: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        size = 0
        for conversation in _by_conversation(batches):
            found = _with_slices(conversation)
            out += found
            size += sum(len(r["text"]) + 100 for r in found)
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=_SLICE)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SLICE)
        give_back()

    parts = shuffle_partitions(pieces.sparkSession)
    dealt = pieces.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part")
    return written(dealt.mapInArrow(work, _SLICE_DDL), "conversation-audits", merge=False)


def _dealt(df: DataFrame) -> DataFrame:
    """Texts and audit slices of every conversation, in order, each slice before its rows."""
    rows = _prepared(df)
    slices = _slices(_pieces(_ordered(rows)))
    texts = rows.where("copies > 0").withColumn("kind", F.lit(1))
    both = slices.unionByName(texts, allowMissingColumns=True)
    parts = shuffle_partitions(df.sparkSession)
    return both.repartition(parts, "conv_id").sortWithinPartitions(*ORDER, "kind")


class _Writer:
    """Repaired turns of one conversation after another, from its slices and texts in order."""

    def __init__(self) -> None:
        self.slice, self.at, self.state = "", 0, NOTHING

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.slice) and self.slice[self.at] == INSERT:
            self.at += 1
            role = NEXT_ROLE[self.state == USER]
            self.state = added(self.state)
            yield INSERT, role, ""

    def rest(self) -> Iterator[tuple[str, str, str]]:
        """What is inserted behind a slice's last row."""
        yield from self._inserted()

    def start(self, audit: str, first: bool) -> None:
        self.slice, self.at = audit, 0
        if first:
            self.state = NOTHING

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(copies):
            yield from self._inserted()
            letter = self.slice[self.at]
            self.at += 1
            if letter == DELETE:
                continue
            if letter == REROLE:
                role_now, self.state = NEXT_ROLE[self.state == USER], added(self.state)
            else:
                initial = INITIALS.index(role[0])
                role_now, self.state = role, kept(self.state, initial)
            yield letter, role_now, text


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator]]:
    """(row, repaired turns that follow from it): a slice's row closes what was before it."""
    writer = _Writer()
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield {"end": True}, writer.rest()
                writer.start(row["text"], row["first"])
                yield row, iter(())
            else:
                yield row, writer.row(row["role"], row["text"], row["copies"])
    yield {"end": True}, writer.rest()


def conversation_audits(df: DataFrame) -> DataFrame:
    """One row for each conversation of ``df`` (see the module's text): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256 (``role:text`` of the repaired
    turns, joined by newlines)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        out: list[tuple] = []
        conversation, digest, joint = None, hashlib.sha256(), b""

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for row, turns in _streamed(batches):
            for _, role, text in turns:
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
            if row.get("first"):
                if conversation is not None:
                    out.append((*conversation, digest.hexdigest()))
                conversation = tuple(row[c] for c in ("conv_id", *COUNTS, "audit"))
                digest, joint = hashlib.sha256(), b""
                if len(out) >= 1000:
                    yield batch()
                    out = []
        if conversation is not None:
            out.append((*conversation, digest.hexdigest()))
            yield batch()
        give_back()

    return _dealt(df).mapInArrow(work, AUDITS)


def repaired_turns(df: DataFrame) -> DataFrame:
    """The turns of every repaired conversation: conv_id, place (from 0), edit (K, R or I), role,
    text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "place", "edit", "role", "text"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        out: list[tuple] = []
        conv_id, place, size = None, 0, 0
        for row, turns in _streamed(batches):
            for edit, role, text in turns:
                out.append((conv_id, place, edit, role, text))
                place, size = place + 1, size + len(text) + 50
            if row.get("first"):
                conv_id, place = row["conv_id"], 0
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        give_back()

    return _dealt(df).mapInArrow(work, TURNS)
