import math

from pyspark.sql import functions as F

from revspark.functions import (
    all_of,
    helpful_votes,
    helpfulness_ratio,
    high_quality,
    min_length,
    min_rating,
    quality,
    quality_ratio,
    review_year,
    sentiment,
    utf16_length,
)


def _eval(spark, values, dtype, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_votes_parse_and_default(spark):
    values = ["10", None, "1,234", " 12 ", "12.0", "abc", "2147483648", "12\n", "+5", "-3", "007"]
    assert _eval(spark, values, "string", helpful_votes) == [10, 0, 0, 0, 0, 0, 0, 0, 5, -3, 7]


def test_sentiment_thresholds(spark):
    got = _eval(spark, [5.0, 4.0, 3.5, 3.0, 2.0, 1.0], "double", sentiment)
    assert got == ["positive", "positive", "neutral", "neutral", "negative", "negative"]


def test_year_is_utc_whatever_the_session_zone(spark):
    values = [1757964116, 1609459200, 1577836800, 946684800, 1609459199]
    expected = [2025, 2021, 2020, 2000, 2020]
    assert _eval(spark, values, "bigint", review_year) == expected
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert _eval(spark, values, "bigint", review_year) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_utf16_length_counts_non_bmp_twice(spark):
    got = _eval(spark, ["abc", "a\U0001F600b", "", None, "é"], "string", utf16_length)
    assert got == [3, 4, 0, 0, 1]


def test_helpfulness_ratio_edges(spark):
    values = [[10, 15], [0, 10], [5, 5], [10, 0], [], [5], [1, 2, 3], None]
    got = _eval(spark, values, "array<int>", helpfulness_ratio)
    assert math.isclose(got[0], 10 / 15)
    assert got[1:] == [0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def _rows(spark, rows):
    return spark.createDataFrame(
        rows, "rating double, reviewLength int, helpfulnessVotes int, helpfulnessRatio double"
    )


def test_min_rating_and_length(spark):
    df = _rows(spark, [(5.0, 20, 0, 0.0), (4.0, 10, 0, 0.0), (3.5, 5, 0, 0.0), (3.0, 50, 0, 0.0)])
    assert sorted(r.rating for r in df.where(min_rating(4.0)).collect()) == [4.0, 5.0]
    assert sorted(r.reviewLength for r in df.where(min_length(10)).collect()) == [10, 20, 50]
    assert df.where(min_length(100)).count() == 0


def test_quality_filters(spark):
    df = _rows(spark, [(4.0, 1, 6, 0.8), (2.5, 1, 10, 0.3), (4.5, 1, 2, 0.2)])
    assert [(r.rating,) for r in df.where(quality(3.0, 5)).collect()] == [(4.0,)]
    ratio = _rows(spark, [(4.5, 1, 0, 0.8), (2.0, 1, 0, 0.3)])
    assert [r.rating for r in ratio.where(quality_ratio(4.0, 0.5)).collect()] == [4.5]
    assert sorted(r.rating for r in ratio.where(quality_ratio(2.0, 0.2)).collect()) == [2.0, 4.5]


def test_all_of_and_summary_presets(spark):
    df = _rows(spark, [(4.0, 100, 0, 0.0), (4.0, 101, 0, 0.0), (3.9, 500, 0, 0.0)])
    assert df.where(all_of(min_rating(4.0), min_length(100))).count() == 2
    assert df.where(all_of()).count() == 3
    assert df.where(high_quality("votes")).count() == 2
    assert df.where(high_quality("ratio")).count() == 1
