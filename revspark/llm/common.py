"""Helpers shared by the operators: written intermediate tables, Arrow text access, hashing."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.scratch import shared_path

U64 = np.uint64


def written(df: DataFrame, name: str, merge: bool = True) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: the lineage is
    cut there, so a lost executor never sends a later step back to the source. It belongs to the
    current scratch scope and goes with it.

    A file for each core, or one for eight shuffle partitions if that is more: a task takes its
    partitions one after the other, so it needs no more memory, and small tables don't end up as
    hundreds of tiny files. ``merge=False`` leaves the tasks as they are, for what numbers its
    rows by task.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    if merge:
        files = max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark) // 8)
        df = df.coalesce(files)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (null: empty), whatever other columns there are."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def crc_mod(id_column, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % F.lit(modulus)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column without copying its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width = np.int32
    else:
        width = np.int64
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, width)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]: offs[-1]], offs - offs[0]


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its tasks, and several of them
    share an executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand rows to Python by the thousand, not by tens of thousands (unless the session
    has its own setting): of texts that is some megabytes, in the JVM and in the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(ARROW_ROWS))


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, build):
    """What a worker keeps between tasks, of one operator at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[key] = build()
    return _KEPT[key]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20,
           keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``max_bytes`` of text (one row at least): numpy arrays over
    a text take some ten times its bytes at a time. What other operators have kept in the worker
    goes, unless ``keep``."""
    if not keep:
        _KEPT.clear()
    for batch in batches:
        _, offs = utf8(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, batch.num_rows
        while start < n:
            end = int(np.searchsorted(offs, offs[start] + max_bytes, side="right")) - 1
            end = min(n, max(end, start + 1))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit integers (xor-shift and multiply)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(31)
    x *= U64(0x9E6C63D0876A9A35)
    x ^= x >> U64(29)
    x *= U64(0xC2B2AE3D27D4EB4F)
    x ^= x >> U64(32)
    return x


_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(U64)
BASE = U64(0x9E3779B97F4A7C15)
_POWERS = {"p": np.ones(1, U64)}


def powers(n: int) -> np.ndarray:
    """BASE**i for i < n, modulo 2**64 (kept between calls)."""
    have = _POWERS["p"]
    if len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            steps = np.full(size, BASE, U64)
            steps[0] = 1
            _POWERS["p"] = have = np.cumprod(steps)
    return have[:n]


_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
_INV = {"p": np.ones(1, U64)}


def inverse_powers(n: int) -> np.ndarray:
    have = _INV["p"]
    if len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            steps = np.full(size, _INVERSE, U64)
            steps[0] = 1
            _INV["p"] = have = np.cumprod(steps)
    return have[:n]


def lookup(separators: bytes | list[int]) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = [0x20, *range(0x09, 0x0E)]


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (run of bytes in ``is_word``) of all rows, in order, and the
    number of words before each row (one entry more, the total, at the end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of a sequence of 64-bit values, from one running sum."""
    n = len(values)
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, U64)
        sums[0] = 0
        np.cumsum(values * powers(n), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse_powers(n + 1)[starts])


def word_hashes(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all rows (A-Z lower-cased), and the number of words before each
    row."""
    starts, ends, rows = word_spans(data, offs, is_word)
    return span_hashes(BYTE_VALUES[LOWER[data]], starts, ends), rows


_SHINGLE = _RNG.integers(1, 2**63, 8, dtype=np.int64).astype(U64) | U64(1)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes; of the whole sequence if there are
    fewer words, and nothing without words."""
    n = len(words)
    if n == 0:
        return words
    with np.errstate(over="ignore"):
        if n < width:
            total = U64(n)
            for k in range(n):
                total = total + words[k] * _SHINGLE[k]
            return mix(np.array([total], U64))
        total = np.zeros(n - width + 1, U64)
        for k in range(width):
            total += words[k: n - width + 1 + k] * _SHINGLE[k]
        return mix(total + U64(width))


def crc32_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
