"""Declared schemas. Reading with a declared schema skips inference and tolerates absent fields."""

from pyspark.sql import types as T

_S, _D, _I, _L, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Raw review, final variant: helpfulness is a vote count held in a string.
REVIEW = _struct(
    ("reviewerID", _S),
    ("asin", _S),
    ("reviewerName", _S),
    ("vote", _S),
    ("reviewText", _S),
    ("overall", _D),
    ("summary", _S),
    ("unixReviewTime", _L),
    ("reviewTime", _S),
    ("image", T.ArrayType(_S)),
    ("verified", _B),
)

# Raw review, draft variant: helpfulness is [helpful_votes, total_votes].
REVIEW_RATIO = _struct(
    ("reviewerID", _S),
    ("asin", _S),
    ("reviewerName", _S),
    ("helpful", T.ArrayType(_I)),
    ("reviewText", _S),
    ("overall", _D),
    ("summary", _S),
    ("unixReviewTime", _L),
)

# Both variants' fields, as produced by the table adapter.
REVIEW_ALL = T.StructType(list(REVIEW.fields) + [T.StructField("helpful", T.ArrayType(_I), True)])

PROCESSED = _struct(
    ("reviewerID", _S),
    ("productID", _S),
    ("rating", _D),
    ("helpfulnessVotes", _I),
    ("reviewLength", _I),
    ("sentiment", _S),
    ("year", _I),
    ("isHighQuality", _B),
)

PROCESSED_RATIO = _struct(
    ("reviewerID", _S),
    ("productID", _S),
    ("rating", _D),
    ("helpfulnessRatio", _D),
    ("reviewLength", _I),
    ("sentiment", _S),
    ("year", _I),
)

PRODUCT_STATS = _struct(
    ("productID", _S),
    ("avgRating", _D),
    ("reviewCount", _L),
    ("avgHelpfulness", _D),
)

PRODUCT_STATS_RATIO = _struct(
    ("productID", _S),
    ("avgRating", _D),
    ("reviewCount", _L),
    ("avgHelpfulness", _D),
    ("dominantSentiment", _S),
)

PROFILE = _struct(
    ("reviewerID", _S),
    ("totalReviews", _L),
    ("avgRating", _D),
    ("avgReviewLength", _D),
    ("helpfulnessScore", _D),
)

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, _S, True)])
