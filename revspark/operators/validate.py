"""Validation and projection of raw reviews (the per-row ``Either`` re-expressed as a column).

A raw row gets a ``reason`` column: null when the row is valid, else why it was rejected. Valid
and rejected rows are then two filters over the same plan, so nothing is ever dropped silently
and one bad row never fails a job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.functions import scalar

# ---- fixed values: rejection messages ---------------------------------------------------------
TEXT_MISSING = "Review text is empty or missing"  # final variant (only a null text)
TEXT_EMPTY = "Review text is empty"  # draft variant (null or "")
INVALID_RATING = "Invalid rating value"
# Our own reasons for rows that would make the reference's job fail as a whole.
MISSING_RATING = "Missing rating"
MISSING_TIME = "Missing review time"
MALFORMED = "Malformed record"
# ----------------------------------------------------------------------------------------------

RATING_MIN, RATING_MAX = 1.0, 5.0
REASON = "reason"


@dataclass(frozen=True)
class Variant:
    """The two helpfulness measures of the reference and the rules that go with each."""

    name: str
    reject_empty_text: bool
    text_reason: str
    helpfulness_column: str


VOTES = Variant("votes", reject_empty_text=False, text_reason=TEXT_MISSING,
                helpfulness_column="helpfulnessVotes")
RATIO = Variant("ratio", reject_empty_text=True, text_reason=TEXT_EMPTY,
                helpfulness_column="helpfulnessRatio")
VARIANTS = {"votes": VOTES, "ratio": RATIO}


def variant_of(variant: str | Variant) -> Variant:
    if isinstance(variant, Variant):
        return variant
    try:
        return VARIANTS[variant]
    except KeyError:
        raise ValueError(f"unknown variant {variant!r}; expected one of {sorted(VARIANTS)}")


def rejection_reason(variant: str | Variant = "votes") -> Column:
    """Why a raw row is rejected, or null. Text is checked before rating, as in the reference."""
    v = variant_of(variant)
    text, rating, time = F.col("reviewText"), F.col("overall"), F.col("unixReviewTime")
    text_bad = text.isNull() | (text == F.lit("")) if v.reject_empty_text else text.isNull()
    # NaN sorts above every number in Spark, so `between` rejects it too.
    return (
        F.when(text_bad, F.lit(v.text_reason))
        .when(rating.isNull(), F.lit(MISSING_RATING))
        .when(~rating.between(F.lit(RATING_MIN), F.lit(RATING_MAX)), F.lit(INVALID_RATING))
        .when(time.isNull(), F.lit(MISSING_TIME))
    )


def validity(variant: str | Variant = "votes") -> Column:
    """True exactly where ``rejection_reason`` is null, as a plain conjunction that a Parquet scan
    can take over (NaN sorts above every number, so it fails the upper bound)."""
    v = variant_of(variant)
    valid = F.col("reviewText").isNotNull()
    if v.reject_empty_text:
        valid = valid & (F.col("reviewText") != F.lit(""))
    rating = F.col("overall")
    return (valid & (rating >= F.lit(RATING_MIN)) & (rating <= F.lit(RATING_MAX))
            & F.col("unixReviewTime").isNotNull())


def classify(raw: DataFrame, variant: str | Variant = "votes") -> DataFrame:
    return raw.withColumn(REASON, rejection_reason(variant))


def accepted(classified: DataFrame, variant: str | Variant = "votes") -> DataFrame:
    """The valid rows of ``classify``, projected to the processed schema."""
    return classified.where(F.col(REASON).isNull()).select(*processed_columns(variant))


def processed_columns(variant: str | Variant = "votes") -> list[Column]:
    """The processed-review projection (rename, derive helpfulness, length, sentiment, year)."""
    v = variant_of(variant)
    if v.name == "votes":
        helpfulness = scalar.helpful_votes("vote").alias("helpfulnessVotes")
    else:
        helpfulness = scalar.helpfulness_ratio("helpful").alias("helpfulnessRatio")
    cols = [
        F.col("reviewerID"),
        F.col("asin").alias("productID"),
        F.col("overall").alias("rating"),
        helpfulness,
        scalar.utf16_length("reviewText").alias("reviewLength"),
        scalar.sentiment("overall").alias("sentiment"),
        scalar.review_year("unixReviewTime").alias("year"),
    ]
    if v.name == "votes":
        cols.append(F.lit(False).alias("isHighQuality"))
    return cols


def valid_reviews(raw: DataFrame, variant: str | Variant = "votes") -> DataFrame:
    """Valid rows, projected to the processed schema."""
    return raw.where(validity(variant)).select(*processed_columns(variant))


def rejected_reviews(raw: DataFrame, variant: str | Variant = "votes") -> DataFrame:
    """Rejected rows: the raw columns plus ``reason``."""
    return classify(raw, variant).where(F.col(REASON).isNotNull())


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    """Rejection counts per reason (partial aggregation, one row per reason)."""
    return rejected.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
