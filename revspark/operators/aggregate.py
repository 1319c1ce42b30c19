"""Per-product and per-reviewer aggregates, and counting.

All are declarative ``groupBy().agg()``: Spark computes partial aggregates in every map task
and shuffles one row per key per task, so a product or reviewer holding a third of all rows
costs no more than any other key. No per-group lists are built anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.functions.scalar import SENTIMENTS


def product_stats(
    processed: DataFrame,
    helpfulness: str = "helpfulnessVotes",
    dominant_sentiment: bool = False,
) -> DataFrame:
    """Per product: mean rating, review count, mean helpfulness [, most frequent sentiment].

    A null productID forms its own group, as in a plain SQL GROUP BY.
    """
    aggs = [
        F.avg("rating").alias("avgRating"),
        F.count(F.lit(1)).alias("reviewCount"),
        F.avg(helpfulness).cast("double").alias("avgHelpfulness"),
    ]
    if dominant_sentiment:
        aggs.append(dominant_sentiment_agg())
    return processed.groupBy("productID").agg(*aggs)


def dominant_sentiment_agg(column: str = "sentiment") -> Column:
    """Most frequent sentiment; ties go to the lowest name, so the answer is deterministic (null
    if no row has one). Three plain counts, so the whole aggregate stays one hash aggregate."""
    counts = [F.count_if(F.col(column) == F.lit(s)) for s in SENTIMENTS]
    most = F.greatest(*counts)
    chosen = F.when(most == 0, F.lit(None).cast("string"))
    for name, count in zip(SENTIMENTS, counts):
        chosen = chosen.when(count == most, F.lit(name))
    return chosen.alias("dominantSentiment")


def dominant_sentiment(processed: DataFrame, key: str = "productID") -> DataFrame:
    return processed.groupBy(key).agg(dominant_sentiment_agg())


def reviewer_profiles(processed: DataFrame, helpfulness: str = "helpfulnessVotes") -> DataFrame:
    """Per reviewer: review count, mean rating, mean length, mean helpfulness."""
    return processed.groupBy("reviewerID").agg(
        F.count(F.lit(1)).alias("totalReviews"),
        F.avg("rating").alias("avgRating"),
        F.avg(F.col("reviewLength").cast("double")).alias("avgReviewLength"),
        F.avg(F.col(helpfulness).cast("double")).alias("helpfulnessScore"),
    )


def count_where(df: DataFrame, predicate: Column | str, alias: str = "n") -> DataFrame:
    """One-row DataFrame holding the number of rows satisfying ``predicate``."""
    pred = F.col(predicate) if isinstance(predicate, str) else predicate
    return df.where(pred).agg(F.count(F.lit(1)).alias(alias))
