from pyspark.sql import functions as F

from revspark.operators.validate import (
    INVALID_RATING,
    MISSING_RATING,
    MISSING_TIME,
    TEXT_EMPTY,
    TEXT_MISSING,
    classify,
    rejected_reviews,
    rejects_by_reason,
    valid_reviews,
)
from revspark.plans.process import process_reviews
from revspark.schemas import REVIEW_ALL
from tests.conftest import as_set, raw_df, raw_review


def test_valid_review_is_projected(spark):
    df = raw_df(spark, [raw_review(vote="77", overall=3.5, reviewText="a quiet fan")])
    row = valid_reviews(df).collect()[0]
    assert (row.productID, row.rating, row.helpfulnessVotes, row.sentiment, row.year,
            row.reviewLength) == ("P1", 3.5, 77, "neutral", 2021, 11)
    assert row.isHighQuality is False


def test_reasons_and_order(spark):
    rows = [
        raw_review(reviewerID="a", reviewText=None),
        raw_review(reviewerID="b", overall=7.0),
        raw_review(reviewerID="c", reviewText=None, overall=7.0),
        raw_review(reviewerID="d", overall=None),
        raw_review(reviewerID="e", unixReviewTime=None),
        raw_review(reviewerID="f", overall=float("nan")),
        raw_review(reviewerID="g", overall=0.999),
        raw_review(reviewerID="h", overall=5.001),
        raw_review(reviewerID="i", overall=1.0),
        raw_review(reviewerID="j", reviewText=""),
    ]
    got = as_set(classify(raw_df(spark, rows)), "reviewerID", "reason")
    assert got == {
        ("a", TEXT_MISSING), ("b", INVALID_RATING), ("c", TEXT_MISSING), ("d", MISSING_RATING),
        ("e", MISSING_TIME), ("f", INVALID_RATING), ("g", INVALID_RATING),
        ("h", INVALID_RATING), ("i", None), ("j", None),
    }


def test_draft_rejects_empty_text(spark):
    rows = [raw_review(reviewerID="a", reviewText="", helpful=[1, 2]),
            raw_review(reviewerID="b", overall=6.0, helpful=[1, 2]),
            raw_review(reviewerID="c", helpful=[1, 2])]
    df = raw_df(spark, rows, REVIEW_ALL)
    assert as_set(rejected_reviews(df, "ratio"), "reviewerID", "reason") == {
        ("a", TEXT_EMPTY), ("b", INVALID_RATING)}
    assert as_set(valid_reviews(df, "ratio"), "reviewerID", "helpfulnessRatio") == {("c", 0.5)}


def test_empty_text_is_valid_with_length_zero_in_final_variant(spark):
    row = valid_reviews(raw_df(spark, [raw_review(reviewText="")])).collect()[0]
    assert row.reviewLength == 0


def test_process_reviews_keeps_valid_and_helpful(spark):
    cases = [  # id, votes, text, rating
        ("kept-high", "64", "Cuts bread like butter", 4.5),
        ("kept-at-both-bounds", "10", "", 2.0),
        ("kept-neutral", "33", "Does the job", 3.9),
        ("votes-below", "9", "Cuts bread", 4.5),
        ("votes-formatted", "1,100", "Cuts bread", 4.5),
        ("votes-missing", None, "Cuts bread", 4.5),
        ("rating-below-filter", "64", "Blunt", 1.99),
        ("rating-invalid", "64", "Blunt", 5.5),
        ("text-missing", "64", None, 4.5),
    ]
    rows = [raw_review(reviewerID=i, vote=v, reviewText=t, overall=r) for i, v, t, r in cases]
    got = as_set(process_reviews(raw_df(spark, rows)), "reviewerID", "sentiment")
    assert got == {("kept-high", "positive"), ("kept-at-both-bounds", "negative"),
                   ("kept-neutral", "neutral")}


def test_valid_rows_are_those_without_a_reason(spark):
    ratings = [None, float("nan"), 0.5, 1.0, 3.0, 5.0, 5.5]
    rows = [raw_review(reviewerID=f"{r}|{t}|{u}", overall=r, reviewText=t, unixReviewTime=u,
                       helpful=[1, 2])
            for r in ratings for t in (None, "", "x") for u in (None, 5)]
    df = raw_df(spark, rows, REVIEW_ALL)
    for variant in ("votes", "ratio"):
        free = classify(df, variant).where("reason IS NULL").select("reviewerID")
        assert as_set(valid_reviews(df, variant), "reviewerID") == as_set(free)


def test_validity_reaches_a_parquet_scan(spark, tmp_dir):
    raw_df(spark, [raw_review()]).write.parquet(f"{tmp_dir}/reviews")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = valid_reviews(spark.read.parquet(f"{tmp_dir}/reviews"))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text.split("PushedFilters:")[1].split("ReadSchema")[0]
    for part in ("IsNotNull(reviewText)", "GreaterThanOrEqual(overall,1.0)",
                 "LessThanOrEqual(overall,5.0)", "IsNotNull(unixReviewTime)"):
        assert part in pushed


def test_rejects_by_reason_counts(spark):
    rows = [raw_review(reviewText=None), raw_review(reviewText=None), raw_review(overall=9.0),
            raw_review()]
    got = as_set(rejects_by_reason(rejected_reviews(raw_df(spark, rows))))
    assert got == {(TEXT_MISSING, 2), (INVALID_RATING, 1)}


def test_no_row_is_lost_between_valid_and_rejected(spark):
    rows = [raw_review(reviewerID=str(i), overall=float(i % 8), reviewText=None if i % 5 == 0
                       else "t") for i in range(40)]
    df = raw_df(spark, rows)
    assert valid_reviews(df).count() + rejected_reviews(df).count() == 40
    assert rejected_reviews(df).where(F.col("reason").isNull()).count() == 0
