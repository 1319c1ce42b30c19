import re

import pytest
from pyspark.sql import functions as F

from revspark.operators.aggregate import product_stats
from revspark.operators.join import enrich, enrich_self
from revspark.operators.window import rank_top_k
from revspark.plans.job import rank_enriched
from revspark.schemas import PROCESSED, PRODUCT_STATS
from tests.conftest import as_set


def processed(spark, rows):
    return spark.createDataFrame([(*r, False) for r in rows], PROCESSED)


def test_enrich_adds_the_products_figures(spark):
    df = processed(spark, [("ada", "oven", 1.0, 50, 12, "negative", 2014),
                           ("ben", "lamp", 3.5, 19, 80, "neutral", 2015),
                           ("cyd", "oven", 4.0, 22, 31, "positive", 2016),
                           ("dov", "oven", 2.5, 90, 7, "negative", 2016)])
    stats = spark.createDataFrame([("lamp", 3.25, 17, 4.0), ("oven", 2.75, 40, 9.5),
                                   ("sieve", 1.0, 1, 0.0)], PRODUCT_STATS)
    got = as_set(enrich(df, stats), "reviewerID", "productAvgRating", "productReviewCount")
    assert got == {("ada", 2.75, 40), ("ben", 3.25, 17), ("cyd", 2.75, 40), ("dov", 2.75, 40)}
    assert enrich(df, stats).columns == PROCESSED.names + ["productAvgRating",
                                                          "productReviewCount"]


def test_enrich_unmatched_and_null_drop(spark):
    df = processed(spark, [("ada", "kite", 3.0, 15, 10, "neutral", 2019),
                           ("ben", None, 2.0, 15, 10, "negative", 2019)])
    stats = spark.createDataFrame([("oven", 1.5, 6, 3.0), (None, 2.5, 3, 30.0)], PRODUCT_STATS)
    assert enrich(df, stats).count() == 0


def test_enrich_self_equals_join(spark):
    rows = [(f"u{i}", None if i % 7 == 0 else f"p{i % 5}", float(1 + i % 5), i, i, "x", 2021)
            for i in range(60)]
    df = processed(spark, rows)
    assert as_set(enrich_self(df)) == as_set(enrich(df, product_stats(df)))


def test_enrich_runs_no_job_and_leaves_the_join_to_aqe(spark):
    df = processed(spark, [("ada", "oven", 1.0, 50, 12, "negative", 2014)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-time", "")
    try:
        out = enrich(df, product_stats(df))
        assert not tracker.getJobIdsForGroup("plan-time")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "strategy=broadcast" not in out._jdf.queryExecution().analyzed().toString()


def ranked(spark, rows):
    return spark.createDataFrame(rows, "reviewerID string, year int, helpfulnessVotes int")


def test_rank_restarts_in_each_year(spark):
    df = ranked(spark, [("ada", 2012, 18), ("ben", 2012, 44), ("cyd", 2012, 18), ("dov", 2012, 3),
                        ("eve", 2013, 5), ("fay", None, 9), ("gus", None, 12), ("hal", 2013, None)])
    assert as_set(rank_top_k(df), "reviewerID", "helpfulnessRank") == {
        ("ben", 1), ("ada", 2), ("cyd", 2), ("dov", 4), ("eve", 1), ("hal", 2), ("gus", 1),
        ("fay", 2)}
    assert as_set(rank_top_k(df, k=2), "reviewerID") == {
        (x,) for x in ("ben", "ada", "cyd", "eve", "hal", "gus", "fay")}


def test_rank_keeps_the_best_k(spark):
    df = ranked(spark, [(f"r{i}", 2010, 7 * i % 401) for i in range(401)])
    out = rank_top_k(df, k=60)
    assert out.count() == 60
    row = out.agg(F.min("helpfulnessVotes"), F.min("helpfulnessRank"), F.max("helpfulnessRank"))
    assert tuple(row.first()) == (341, 1, 60)


@pytest.mark.parametrize("k", [3, 5000])
def test_rank_by_any_k_equals_a_window(spark, k):
    from pyspark.sql import Window

    df = spark.range(12_000).selectExpr(
        "cast(id AS string) AS reviewerID", "cast(2000 + id % 2 AS int) AS year",
        "cast(id * 7919 % 6151 AS int) AS helpfulnessVotes")
    spec = Window.partitionBy("year").orderBy(F.desc("helpfulnessVotes"))
    plain = df.withColumn("helpfulnessRank", F.rank().over(spec)).where(f"helpfulnessRank <= {k}")
    assert as_set(rank_top_k(df, k=k)) == as_set(plain)


def test_rank_ties_are_all_kept(spark):
    rows = [(f"a{i}", 1999, 81 + i) for i in range(3)] + [(f"t{i}", 1999, 2) for i in range(240)]
    out = rank_top_k(ranked(spark, rows), k=10)
    assert out.count() == 243
    assert as_set(out.where("helpfulnessVotes = 2"), "helpfulnessRank") == {(4,)}
    everyone = rank_top_k(ranked(spark, [(f"t{i}", 1999, 2) for i in range(500)]), k=1)
    assert everyone.count() == 500


def test_no_window_sees_review_rows(spark):
    df = ranked(spark, [(f"u{i}", 2020 + i % 3, i % 40) for i in range(300)])
    plan = rank_top_k(df)._jdf.queryExecution().executedPlan().toString()
    for line in re.findall(r".*Window.*", plan):
        assert "reviewerID" not in line


def test_rank_enriched_equals_rank_of_enriched(spark):
    rows = [(f"u{i}", None if i % 11 == 0 else f"p{i % 13}", float(1 + i % 5), i % 17, i,
             "x", 2015 + i % 4) for i in range(400)]
    df = processed(spark, rows)
    stats = product_stats(df)
    direct = rank_top_k(enrich(df, stats), k=20)
    assert as_set(rank_enriched(df, stats, "helpfulnessVotes", k=20)) == as_set(direct)
