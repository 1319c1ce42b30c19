"""Ranges of a composite order, cut inside the plan.

``splitters`` is a scalar subquery: a bounded sample of the order's values, taken by the least hashes
of the rows, sorted, every k-th one kept. It runs when the query runs (nothing happens while the plan is
built), and being chosen by hash it is the same whenever it is computed again. ``with_range``
finds a row's range by binary search over the splitters, so a row's range is a fixed function of its order
values: every branch of a plan and every recomputed task sees the same ranges.

The order may have several columns of any orderable type (numbers, strings, dates, timestamps); nulls
come first and NaN last, as Spark sorts them. Rows tied in the first column are split by the next
ones; only rows alike in all of them share a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES_PER_PARTITION = 4  # hashing ranges to shuffle partitions evens out
MAX_RANGES = 1 << 15
SAMPLE_PER_RANGE = 20  # as many sampled rows decide a splitter: ranges are even to about a fifth


def range_count(df: DataFrame, ranges: int | None = None) -> int:
    """How many ranges: asked for, or a few for each shuffle partition."""
    if ranges is None:
        ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(ranges, MAX_RANGES))


def splitters(df: DataFrame, order: Sequence[str], ranges: int) -> Column:
    """``ranges - 1`` (or a few less) order values of ``df`` in ascending order, as an array of
    structs; none of an empty table."""
    sample = ranges * SAMPLE_PER_RANGE
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    chosen = df.select(F.struct(*fields).alias("v"), F.xxhash64(*order).alias("h")).orderBy(
        "h").limit(sample)
    ordered = chosen.agg(F.sort_array(F.collect_list("v")).alias("v"))
    n = F.size("v")
    places = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)),
                         lambda i: F.floor(i * n / F.lit(ranges)).cast("int"))
    cuts = F.transform(F.array_distinct(places), lambda i: F.get(F.col("v"), i))
    return ordered.select(F.when(n > 0, cuts).otherwise(F.slice("v", 1, 0)).alias("v")).scalar()


def with_range(df: DataFrame, out: str, order: Sequence[str], cuts: Column, ranges: int
               ) -> DataFrame:
    """``df`` with the number of splitters that are not above each row: its range, 0 to
    ``ranges - 1``. A level of the binary search is a column, so the search stays in generated code."""
    row, known, low = "__order_value", "__splitters", "__low"
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    columns = [F.struct(*fields).alias(row), cuts.alias(known), F.lit(0).alias(low)]
    for level in reversed(range((ranges - 1).bit_length())):
        width, higher = 1 << level, f"{low}_"
        # A splitter beyond the last one is null, and so is the comparison: the search stays below.
        ahead = F.get(F.col(known), F.col(low) + F.lit(width - 1)) <= F.col(row)
        columns.append(F.when(ahead, F.col(low) + F.lit(width)).otherwise(F.col(low)).alias(higher))
        low = higher
    return df.select("*", *columns).select(*[df[f"`{c}`"] for c in df.columns],
                                           F.col(low).alias(out))
