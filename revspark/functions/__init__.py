from revspark.functions.predicates import (
    all_of,
    high_quality,
    longer_than,
    min_length,
    min_rating,
    quality,
    quality_ratio,
)
from revspark.functions.scalar import (
    epoch_seconds_utc,
    helpful_votes,
    helpfulness_ratio,
    review_year,
    sentiment,
    utf16_length,
)

__all__ = [
    "all_of",
    "epoch_seconds_utc",
    "helpful_votes",
    "helpfulness_ratio",
    "high_quality",
    "longer_than",
    "min_length",
    "min_rating",
    "quality",
    "quality_ratio",
    "review_year",
    "sentiment",
    "utf16_length",
]
