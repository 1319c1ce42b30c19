"""Row-update combinators on DataFrames: conditional update and composition."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.functions.predicates import high_quality

Transform = Callable[[DataFrame], DataFrame]


def when_then(df: DataFrame, predicate: Column, updates: Mapping[str, Column]) -> DataFrame:
    """Apply ``updates`` to the rows where ``predicate`` holds; other rows are unchanged.

    One ``withColumns`` call, so every new value and the predicate see the original row (a chain
    of ``withColumn`` would let a later update see an earlier one). A null predicate leaves the
    row unchanged.
    """
    return df.withColumns(
        {name: F.when(predicate, value).otherwise(F.col(name)) for name, value in updates.items()}
    )


def mark_high_quality(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Set ``isHighQuality`` where the predicate holds (default: the final summary predicate)."""
    pred = high_quality("votes") if predicate is None else predicate
    if "isHighQuality" not in df.columns:
        df = df.withColumn("isHighQuality", F.lit(False))
    return when_then(df, pred, {"isHighQuality": F.lit(True)})


def pipe(*transforms: Transform) -> Transform:
    """Left-to-right composition: ``pipe(f, g)(df) == g(f(df))``; use with ``df.transform``."""

    def composed(df: DataFrame) -> DataFrame:
        return functools.reduce(lambda acc, fn: acc.transform(fn), transforms, df)

    return composed
