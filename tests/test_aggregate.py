import pytest

from revspark.operators.aggregate import (
    count_where,
    dominant_sentiment,
    product_stats,
    reviewer_profiles,
)
from revspark.schemas import PROCESSED
from tests.conftest import as_set


def processed(spark, rows):
    """rows: (reviewerID, productID, rating, votes, length, sentiment, year)."""
    return spark.createDataFrame([(*r, False) for r in rows], PROCESSED)


def test_product_stats(spark):
    df = processed(spark, [("ada", "oven", 3.0, 31, 140, "neutral", 2016),
                           ("ben", "oven", 4.5, 11, 25, "positive", 2017),
                           ("cyd", "oven", 1.5, 18, 60, "negative", 2016),
                           ("ada", "sieve", 2.5, 47, 8, "negative", 2019)])
    assert as_set(product_stats(df)) == {("oven", 3.0, 3, 20.0), ("sieve", 2.5, 1, 47.0)}


def test_product_stats_empty(spark):
    assert product_stats(processed(spark, [])).count() == 0


def test_null_product_is_its_own_group(spark):
    df = processed(spark, [("ada", None, 1.0, 40, 3, "negative", 2015),
                           ("ben", None, 5.0, 14, 9, "positive", 2018),
                           ("ben", "oven", 2.0, 6, 9, "negative", 2018)])
    assert as_set(product_stats(df)) == {(None, 3.0, 2, 27.0), ("oven", 2.0, 1, 6.0)}


def test_dominant_sentiment_ties_take_lowest(spark):
    rows = [("u", "p1", 5.0, 1, 1, s, 2021) for s in ["positive", "negative", "neutral",
                                                       "positive", "negative"]]
    rows += [("u", "p2", 5.0, 1, 1, s, 2021) for s in ["positive", "neutral", "neutral"]]
    assert as_set(dominant_sentiment(processed(spark, rows))) == {("p1", "negative"),
                                                                 ("p2", "neutral")}
    stats = product_stats(processed(spark, rows), dominant_sentiment=True)
    assert "dominantSentiment" in stats.columns


def test_dominant_sentiment_without_any(spark):
    df = processed(spark, [("u", "oven", 1.0, 1, 1, None, 2021)])
    assert as_set(dominant_sentiment(df)) == {("oven", None)}


def test_dominant_sentiment_is_one_hash_aggregate(spark):
    df = processed(spark, [("u", "oven", 1.0, 1, 1, "negative", 2021)])
    plan = product_stats(df, dominant_sentiment=True)._jdf.queryExecution().executedPlan()
    assert "ObjectHashAggregate" not in plan.toString()
    assert "SortAggregate" not in plan.toString()


def test_reviewer_profiles(spark):
    df = processed(spark, [("ada", "oven", 3.5, 16, 90, "neutral", 2016),
                           ("ben", "sieve", 1.0, 5, 44, "negative", 2017),
                           ("ada", "lamp", 2.0, 21, 30, "negative", 2018),
                           ("ada", "sieve", 5.0, 8, 15, "positive", 2018)])
    assert as_set(reviewer_profiles(df)) == {("ada", 3, 3.5, 45.0, 15.0), ("ben", 1, 1.0, 44.0, 5.0)}
    assert reviewer_profiles(processed(spark, [])).count() == 0


def test_count_where(spark):
    df = processed(spark, [("u1", "p1", float(r), 1, 1, "x", 2021) for r in range(1, 6)])
    from pyspark.sql import functions as F

    assert count_where(df, F.col("rating") >= 4).collect()[0]["n"] == 2
    assert count_where(df.limit(0), F.col("rating") >= 4).collect()[0]["n"] == 0


def test_stats_and_profiles_reconcile_on_tables(spark):
    from revspark.plans.process import process_reviews
    from revspark.sources.adapter import reviews_from_tables
    from pyspark.sql import functions as F

    p = process_reviews(reviews_from_tables(spark, "/root/testdata/sf0.001"))
    s = product_stats(p).agg(F.sum("reviewCount").alias("n"),
                             F.sum(F.col("avgRating") * F.col("reviewCount")).alias("r"),
                             F.sum(F.col("avgHelpfulness") * F.col("reviewCount")).alias("v"))
    r = reviewer_profiles(p).agg(F.sum("totalReviews").alias("n"),
                                 F.sum(F.col("avgRating") * F.col("totalReviews")).alias("r"),
                                 F.sum(F.col("helpfulnessScore") * F.col("totalReviews"))
                                 .alias("v"))
    a, b = s.collect()[0], r.collect()[0]
    assert a.n == b.n == p.count() > 0
    assert a.r == pytest.approx(b.r) and a.v == pytest.approx(b.v)
