"""Enrich reviews with their product's figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.operators.aggregate import product_stats

ENRICH_COLUMNS = ("productAvgRating", "productReviewCount")


def enrich(processed: DataFrame, stats: DataFrame) -> DataFrame:
    """Inner equi-join on productID; rows whose product has no stats (or a null id) drop.

    No hint and no job at plan time: AQE picks the join from the measured size of the stats
    (one row per product), and splits a product that holds a large share of the reviews if
    both sides are shuffled.
    """
    right = stats.select(
        F.col("productID"),
        F.col("avgRating").alias("productAvgRating"),
        F.col("reviewCount").alias("productReviewCount"),
    )
    return processed.join(right, on="productID", how="inner").select(
        *processed.columns, *ENRICH_COLUMNS
    )


def enrich_self(processed: DataFrame) -> DataFrame:
    """``enrich`` with the product stats of the same reviews."""
    return enrich(processed, product_stats(processed))
