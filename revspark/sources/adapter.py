"""Raw reviews derived from the driver's tables (``lineitem`` joined to ``orders``).

The driver tables hold no reviews, so every review is a line item of an order: the customer is
the reviewer, the part the product. Edge cases the operators must handle are planted by fixed
rules on the order key: null, formatted and non-numeric votes; null, empty and non-BMP text;
ratings outside 1..5. Every line item becomes one review, so the source grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.functions.scalar import epoch_seconds_utc
from revspark.session import sf_table

# ---- fixed values: the planted edge cases (shared with the SQL oracle) -----------------------
NULL_NAME_EVERY = 10  # o_custkey % 10 == 0 -> no reviewer name
NULL_VOTE_EVERY, COMMA_VOTE_EVERY, TEXT_VOTE_EVERY = 7, 11, 13
COMMA_VOTE, TEXT_VOTE = "1,234", "n/a"
NULL_TEXT_EVERY, EMPTY_TEXT_EVERY, EMOJI_TEXT_EVERY = 17, 19, 23
EMOJI_WORD, PLAIN_WORD, WORDS_PER_LINE = "good \U0001F600 ", "review ", 6
ZERO_RATING_EVERY, SIX_RATING_EVERY = 29, 31
REVIEW_TIME_FORMAT = "MM dd, yyyy"  # e.g. "01 01, 2021"
TOTAL_VOTES_STEP = 20  # helpful = [quantity, (linenumber % 4) * 20]
# ----------------------------------------------------------------------------------------------


def _every(col: str, n: int):
    return (F.col(col) % F.lit(n)) == 0


def reviews_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw review per line item, with both helpfulness fields (``vote`` and ``helpful``)."""
    items = sf_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    orders = sf_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")

    cust = F.col("o_custkey").cast("string")
    quantity = F.col("l_quantity").cast("int")
    words = F.col("l_linenumber") * F.lit(WORDS_PER_LINE)
    return joined.select(
        F.concat(F.lit("U"), cust).alias("reviewerID"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("asin"),
        F.when(_every("o_custkey", NULL_NAME_EVERY), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Name "), cust))
        .alias("reviewerName"),
        F.when(_every("l_orderkey", NULL_VOTE_EVERY), F.lit(None).cast("string"))
        .when(_every("l_orderkey", COMMA_VOTE_EVERY), F.lit(COMMA_VOTE))
        .when(_every("l_orderkey", TEXT_VOTE_EVERY), F.lit(TEXT_VOTE))
        .otherwise(quantity.cast("string"))
        .alias("vote"),
        F.when(_every("l_orderkey", NULL_TEXT_EVERY), F.lit(None).cast("string"))
        .when(_every("l_orderkey", EMPTY_TEXT_EVERY), F.lit(""))
        .when(_every("l_orderkey", EMOJI_TEXT_EVERY), F.repeat(F.lit(EMOJI_WORD), words))
        .otherwise(F.repeat(F.lit(PLAIN_WORD), words))
        .alias("reviewText"),
        F.when(_every("l_orderkey", ZERO_RATING_EVERY), F.lit(0.0))
        .when(_every("l_orderkey", SIX_RATING_EVERY), F.lit(6.0))
        .otherwise(
            F.lit(1.0) + ((F.col("l_partkey") + F.col("l_linenumber")) % F.lit(9)).cast("double")
            * F.lit(0.5)
        )
        .cast("double")
        .alias("overall"),
        F.col("l_returnflag").alias("summary"),
        epoch_seconds_utc("l_shipdate").alias("unixReviewTime"),
        F.date_format(F.col("l_shipdate"), REVIEW_TIME_FORMAT).alias("reviewTime"),
        F.lit(None).cast("array<string>").alias("image"),
        (F.col("o_orderstatus") == F.lit("F")).alias("verified"),
        F.array(quantity, (F.col("l_linenumber") % F.lit(4)) * F.lit(TOTAL_VOTES_STEP))
        .cast("array<int>")
        .alias("helpful"),
    )
