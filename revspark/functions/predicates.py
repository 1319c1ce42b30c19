"""Predicates over processed reviews, as Column expressions.

Being Columns rather than Python callables, Catalyst can combine them, simplify them and push
them into the scan.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F


def min_rating(threshold: float) -> Column:
    return F.col("rating") >= F.lit(float(threshold))


def min_length(threshold: int) -> Column:
    return F.col("reviewLength") >= F.lit(int(threshold))


def longer_than(threshold: int) -> Column:
    return F.col("reviewLength") > F.lit(int(threshold))


def quality(min_rating_: float, min_votes: int) -> Column:
    """Final variant: rating and vote count both at least their thresholds."""
    return min_rating(min_rating_) & (F.col("helpfulnessVotes") >= F.lit(int(min_votes)))


def quality_ratio(min_rating_: float, min_ratio: float) -> Column:
    """Draft variant: rating and helpfulness ratio both at least their thresholds."""
    return min_rating(min_rating_) & (F.col("helpfulnessRatio") >= F.lit(float(min_ratio)))


def all_of(*predicates: Column) -> Column:
    """n-ary conjunction; ``all_of(p, q)`` is the two-predicate ``and``."""
    if not predicates:
        return F.lit(True)
    return functools.reduce(operator.and_, predicates)


# The summary ("high quality") predicate exists in two forms: the final job keeps length >= 100,
# the draft's evident intent is length > 100. Both with rating >= 4.0.
HIGH_QUALITY_MIN_RATING = 4.0
HIGH_QUALITY_LENGTH = 100


def high_quality(variant: str = "votes") -> Column:
    if variant == "votes":
        return all_of(min_rating(HIGH_QUALITY_MIN_RATING), min_length(HIGH_QUALITY_LENGTH))
    if variant == "ratio":
        return all_of(min_rating(HIGH_QUALITY_MIN_RATING), longer_than(HIGH_QUALITY_LENGTH))
    raise ValueError(f"unknown variant {variant!r}")
