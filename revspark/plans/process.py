"""Processing of raw reviews: validate, project, keep the ones that pass the quality filter."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revspark.functions.predicates import quality, quality_ratio
from revspark.operators.validate import valid_reviews

# ---- fixed values: the quality thresholds each variant's job uses ----------------------------
MIN_RATING = 2.0
MIN_VOTES = 10  # final variant
MIN_RATIO = 0.3  # draft variant
# ----------------------------------------------------------------------------------------------


def keep_quality(valid: DataFrame, variant: str = "votes", min_rating: float = MIN_RATING,
                 min_helpfulness: float | None = None) -> DataFrame:
    """Valid reviews that pass a variant's rating and helpfulness thresholds."""
    if variant == "votes":
        votes = MIN_VOTES if min_helpfulness is None else int(min_helpfulness)
        return valid.where(quality(min_rating, votes))
    ratio = MIN_RATIO if min_helpfulness is None else float(min_helpfulness)
    return valid.where(quality_ratio(min_rating, ratio))


def process_reviews(raw: DataFrame, min_rating: float = MIN_RATING,
                    min_votes: int = MIN_VOTES) -> DataFrame:
    """Final variant: valid reviews with rating >= min_rating and votes >= min_votes."""
    return keep_quality(valid_reviews(raw, "votes"), "votes", min_rating, min_votes)


def process_reviews_by_ratio(raw: DataFrame, min_rating: float = MIN_RATING,
                             min_ratio: float = MIN_RATIO) -> DataFrame:
    """Draft variant: non-empty text; helpfulness is a ratio; rating and ratio thresholds."""
    return keep_quality(valid_reviews(raw, "ratio"), "ratio", min_rating, min_ratio)
