"""The full batch job: processed reviews -> product stats, ranked reviews, reviewer profiles,
high-quality count; with the rejected rows kept beside them.

The raw reviews are classified once (valid, or why not); every output is a lazy DataFrame over
that one table. ``run_job`` keeps it while the outputs are written, because all of them read it,
and releases it afterwards: the input is read and parsed once. What a run writes is published as a
whole (``sources.publish``), so readers never see tables of two runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.functions.predicates import high_quality
from revspark.operators.aggregate import count_where, product_stats, reviewer_profiles
from revspark.operators.join import ENRICH_COLUMNS, enrich
from revspark.operators.transform import mark_high_quality
from revspark.operators.validate import (
    MALFORMED,
    REASON,
    accepted,
    classify,
    rejects_by_reason,
    variant_of,
)
from revspark.operators.window import rank_top_k
from revspark.plans.process import MIN_RATING, keep_quality
from revspark.schemas import REVIEW, REVIEW_RATIO
from revspark.scratch import kept_table, scratch
from revspark.session import size_shuffle_for
from revspark.sources.publish import new_run, publish
from revspark.sources.reviews import read_review_lines
from revspark.sources.sinks import persist, write_json, write_parquet

TOP_K = 100


@dataclass
class JobOutputs:
    classified: DataFrame
    processed: DataFrame
    rejected: DataFrame
    rejects_by_reason: DataFrame
    product_stats: DataFrame
    enriched: DataFrame
    ranked_reviews: DataFrame
    reviewer_profiles: DataFrame
    high_quality_count: DataFrame

    def unpersist(self) -> None:
        """Release what ``cache="persist"`` keeps; written tables go with their scratch scope."""
        self.classified.unpersist()
        self.product_stats.unpersist()


def rank_enriched(processed: DataFrame, stats: DataFrame, order_column: str,
                  k: int = TOP_K) -> DataFrame:
    """``rank_top_k(enrich(processed, stats))`` for stats computed from ``processed`` itself.

    With such stats every review with a non-null productID has exactly one match, so the join
    only drops null ids and adds two columns: ranking first and joining the survivors gives the
    same rows while the join touches few of them.
    """
    ranked = rank_top_k(processed.where(F.col("productID").isNotNull()), "year", order_column, k)
    return enrich(ranked, stats).select(*processed.columns, *ENRICH_COLUMNS, "helpfulnessRank")


def _keep(df: DataFrame, mode: str | bool | None, name: str) -> DataFrame:
    """Keep a table that several outputs read.

    "checkpoint": written once to the shared checkpoint folder (``spark.checkpoint.dir``) and owned by
    the current scratch scope; the lineage is cut, so losing executors never sends the job back to the
    source. "persist": cached in executors (memory, then disk); lost blocks are recomputed from the
    plan.
    """
    if not mode:
        return df
    if mode is True or mode == "persist":
        return persist(df)
    if mode == "checkpoint":
        return kept_table(df, name)
    raise ValueError("cache must be False, True, 'persist' or 'checkpoint'")


def build_outputs(raw: DataFrame, variant: str = "votes", min_rating: float = MIN_RATING,
                  min_helpfulness: float | None = None, k: int = TOP_K,
                  cache: str | bool = False) -> JobOutputs:
    """All outputs of the job for one variant ("votes": final, "ratio": draft).

    ``raw`` may come with a ``reason`` of its own for rows that can't be reviews at all.
    ``cache`` keeps the classified reviews and the product stats, which several outputs read:
    False (recompute), True / "persist", or "checkpoint" (see ``_keep``).
    """
    v = variant_of(variant)
    classified = classify(raw.drop(REASON), v)
    if REASON in raw.columns:
        own = F.col("__own")
        classified = classify(raw.withColumnRenamed(REASON, "__own"), v).withColumn(
            REASON, F.coalesce(own, F.col(REASON))).drop("__own")
    classified = _keep(classified, cache, "classified")
    processed = keep_quality(accepted(classified, v), v.name, min_rating, min_helpfulness)
    stats = _keep(
        product_stats(processed, v.helpfulness_column, dominant_sentiment=(v.name == "ratio")),
        cache, "product-stats",
    )
    rejected = classified.where(F.col(REASON).isNotNull())
    if v.name == "votes":
        flagged = mark_high_quality(processed, high_quality("votes"))
        hq = count_where(flagged, "isHighQuality", alias="highQualityCount")
    else:
        hq = count_where(processed, high_quality("ratio"), alias="highQualityCount")
    return JobOutputs(
        classified=classified,
        processed=processed,
        rejected=rejected,
        rejects_by_reason=rejects_by_reason(rejected),
        product_stats=stats,
        enriched=enrich(processed, stats),
        ranked_reviews=rank_enriched(processed, stats, v.helpfulness_column, k),
        reviewer_profiles=reviewer_profiles(processed, v.helpfulness_column),
        high_quality_count=hq,
    )


def write_outputs(outputs: JobOutputs, output_path: str, partition_ranked_by_year: bool = False,
                  keep_rejected: bool = True) -> int:
    """Write the three tables (JSON, Parquet, JSON), the rejected rows and the malformed input lines
    as a new run beside the earlier ones, and publish them together; return the high-quality count.

    Read them with ``sources.read_published``."""
    spark = outputs.product_stats.sparkSession
    run = new_run(output_path)
    tables = ["product_stats", "ranked_reviews", "reviewer_profiles"]
    try:
        write_json(outputs.product_stats, f"{run}/product_stats")
        write_parquet(outputs.ranked_reviews, f"{run}/ranked_reviews",
                      partition_by=["year"] if partition_ranked_by_year else None)
        write_json(outputs.reviewer_profiles, f"{run}/reviewer_profiles")
        if keep_rejected:
            rejected = outputs.rejected
            if "line" in rejected.columns:
                bad = F.col(REASON) == F.lit(MALFORMED)
                write_parquet(rejected.where(bad).select("line", REASON),
                              f"{run}/malformed_lines")
                rejected = rejected.where(~bad).drop("line")
                tables.append("malformed_lines")
            write_parquet(rejected, f"{run}/rejected_reviews")
            tables.append("rejected_reviews")
        count = int(outputs.high_quality_count.first()["highQualityCount"])
        publish(spark, run, tables)
        return count
    finally:
        outputs.unpersist()


def run_job(spark: SparkSession, input_path: str, output_path: str, variant: str = "votes",
            on_missing: str = "raise", cache: str | bool = "checkpoint",
            partition_ranked_by_year: bool = False, size_shuffle: bool = False,
            **kwargs) -> int:
    """Read JSON reviews, build every output, write and publish them; returns the high-quality count.

    Lines that are not JSON objects of the review schema go to ``malformed_lines`` with a
    reason instead of failing the job or turning into all-null reviews. ``size_shuffle`` sets
    the shuffle partition count and split size from the input's size (``session.scale_conf``).
    What the job keeps for itself is removed at its end, on failure too.
    """
    if size_shuffle:
        size_shuffle_for(spark, input_path)
    schema = REVIEW if variant_of(variant).name == "votes" else REVIEW_RATIO
    lines = read_review_lines(spark, input_path, schema, on_missing=on_missing)
    raw = lines.withColumns({
        REASON: F.when(F.col("malformed"), F.lit(MALFORMED)),
        "line": F.when(F.col("malformed"), F.col("line")),  # good lines needn't be kept
    }).drop("malformed")
    with scratch(spark):
        outputs = build_outputs(raw, variant, cache=cache, **kwargs)
        return write_outputs(outputs, output_path, partition_ranked_by_year)
