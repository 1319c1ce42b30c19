"""Sinks and caching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one file per task. Null fields are left out of a line, so read back with
    the declared schema."""
    df.write.mode(mode).json(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def persist(df: DataFrame) -> DataFrame:
    """Keep a table that several outputs read; blocks that do not fit in memory go to disk, and
    blocks lost with an executor are recomputed from the plan."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
