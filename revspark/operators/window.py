"""Top-k per group by rank, ties kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_top_k(
    df: DataFrame,
    partition_by: str | Sequence[str] = "year",
    order_by: str | Sequence[str] = "helpfulnessVotes",
    k: int = 100,
    rank_column: str = "helpfulnessRank",
    descending: bool | Sequence[bool] = True,
) -> DataFrame:
    """Rows with ``rank() <= k`` within each partition; ties share a rank, so a group may keep
    more than k rows.

    A row's rank is one more than the number of rows with better values, so it follows from
    counts: rows per (partition, value) by a partial aggregate, the k best distinct values of
    each partition (rank <= k implies that), and a running sum over those. Rows then join that
    table of at most k rows per partition. No window sees review rows, so a year of any size, or
    any number of ties, is never gathered in one task.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    values = [order_by] if isinstance(order_by, str) else list(order_by)
    down = [descending] * len(values) if isinstance(descending, bool) else list(descending)
    by = parts + values
    names = {c: f"__rank_{i}" for i, c in enumerate(by)}
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).withColumnsRenamed(names)
    best_first = [F.desc(names[v]) if d else F.asc(names[v]) for v, d in zip(values, down)]
    spec = Window.partitionBy(*[names[p] for p in parts]).orderBy(*best_first)
    best = counts.withColumn("__i", F.row_number().over(spec)).where(F.col("__i") <= k)
    better = F.sum("__n").over(spec.rowsBetween(Window.unboundedPreceding, -1))
    best = best.withColumn(rank_column, (F.coalesce(better, F.lit(0)) + 1).cast("int"))
    best = best.where(F.col(rank_column) <= k)
    same = reduce(and_, (df[c].eqNullSafe(best[names[c]]) for c in by))
    return df.join(best, same).select(*df.columns, rank_column)
