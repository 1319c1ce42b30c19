"""Registered queries over the driver's tables: each takes (spark, sf_dir), returns a DataFrame.

Every query reads whole tables (reviews are derived from ``lineitem`` joined to ``orders``, runs
use ``events`` and ``conversations``); column names match the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.functions.predicates import high_quality, min_length, min_rating, quality
from revspark.operators.aggregate import dominant_sentiment, product_stats, reviewer_profiles
from revspark.operators.join import enrich, enrich_self
from revspark.operators.percentile import lower_percentile
from revspark.operators.runs import consecutive_runs, tag_runs
from revspark.operators.transform import mark_high_quality, pipe, when_then
from revspark.operators.validate import rejected_reviews, rejects_by_reason, valid_reviews
from revspark.plans.job import build_outputs, rank_enriched, run_job
from revspark.plans.process import process_reviews, process_reviews_by_ratio
from revspark.schemas import PRODUCT_STATS, PRODUCT_STATS_RATIO, PROFILE, REVIEW, REVIEW_RATIO
from revspark.scratch import shared_path
from revspark.session import sf_table
from revspark.sources.adapter import reviews_from_tables
from revspark.sources.publish import read_published
from revspark.sources.reviews import parse_json_column, read_reviews, read_reviews_checked
from revspark.sources.sinks import write_json, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

# ---- fixed values: parameters of the registered queries (shared with the oracle SQL) ---------
PERCENTILE = 90.0
MEDIAN = 50.0
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
BROKEN_LINE = "order "  # and the order's key: lines among the JSON reviews that are no JSON
LINES_PER_FILE = 250_000  # gzip files aren't split when read, so each holds this many lines at most
# ----------------------------------------------------------------------------------------------


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_from_tables(spark, sf)


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    return process_reviews(_raw(spark, sf))


def _processed_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return process_reviews_by_ratio(_raw(spark, sf))


def q_reviews_adapter(spark, sf):
    return _raw(spark, sf)


def q_valid_reviews(spark, sf):
    return valid_reviews(_raw(spark, sf), "votes")


def q_rejected_reviews(spark, sf):
    return rejected_reviews(_raw(spark, sf), "votes")


def q_rejects_by_reason(spark, sf):
    return rejects_by_reason(rejected_reviews(_raw(spark, sf), "votes"))


def q_rejects_by_reason_ratio(spark, sf):
    return rejects_by_reason(rejected_reviews(_raw(spark, sf), "ratio"))


def q_process_reviews(spark, sf):
    return _processed(spark, sf)


def q_product_stats(spark, sf):
    return product_stats(_processed(spark, sf))


def q_dominant_sentiment(spark, sf):
    return dominant_sentiment(_processed(spark, sf))


def q_enrich_reviews(spark, sf):
    processed = _processed(spark, sf)
    return enrich(processed, product_stats(processed))


def q_enrich_self(spark, sf):
    return enrich_self(_processed(spark, sf))


def q_rank_reviews(spark, sf):
    processed = _processed(spark, sf)
    return rank_enriched(processed, product_stats(processed), "helpfulnessVotes")


def q_reviewer_profiles(spark, sf):
    return reviewer_profiles(_processed(spark, sf))


def q_high_quality_count(spark, sf):
    return build_outputs(_raw(spark, sf), "votes").high_quality_count


def q_high_quality_count_ratio(spark, sf):
    return build_outputs(_raw(spark, sf), "ratio").high_quality_count


def q_percentile_by_product(spark, sf):
    return lower_percentile(_processed(spark, sf), "rating", PERCENTILE, by="productID",
                            alias="ratingP90")


def q_percentile_global(spark, sf):
    return lower_percentile(_processed(spark, sf), "rating", PERCENTILE, alias="ratingP90")


def q_median_length_by_year(spark, sf):
    return lower_percentile(_processed(spark, sf), "reviewLength", MEDIAN, by="year",
                            alias="lengthP50")


def q_event_runs_by_user(spark, sf):
    events = sf_table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return consecutive_runs(events, key="event_type", order="event_id", partition_by="user_id")


def q_event_runs_global(spark, sf):
    events = sf_table(spark, sf, "events").select("event_id", "event_type")
    return consecutive_runs(events, key="event_type", order="event_id")


def q_event_runs_by_time(spark, sf):
    """All events in order of their time, ties by id."""
    events = sf_table(spark, sf, "events").select("ts", "event_id", "event_type")
    runs = consecutive_runs(events, key="event_type", order=["ts", "event_id"])
    return runs.withColumns({c: F.date_format(c, TIME_FORMAT) for c in ("first_ts", "last_ts")})


def q_event_runs_tied_order(spark, sf):
    """Runs in an order whose first column has a handful of values: rows tied in it are told apart by
    the next ones, a string-ordered partition key beside them."""
    events = sf_table(spark, sf, "events").select(
        "event_type", (F.col("user_id") % 3).alias("shard"), "event_id",
        (F.col("value") >= 50).alias("high"))
    return consecutive_runs(events, key="high", order=["shard", "event_id"],
                            partition_by="event_type")


def q_conversation_role_runs(spark, sf):
    turns = sf_table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return consecutive_runs(turns, key="role", order="turn", partition_by="conv_id")


def q_process_reviews_by_ratio(spark, sf):
    return _processed_ratio(spark, sf)


def q_product_stats_ratio(spark, sf):
    return product_stats(_processed_ratio(spark, sf), "helpfulnessRatio", dominant_sentiment=True)


def q_rank_reviews_ratio(spark, sf):
    processed = _processed_ratio(spark, sf)
    stats = product_stats(processed, "helpfulnessRatio", dominant_sentiment=True)
    return rank_enriched(processed, stats, "helpfulnessRatio")


def q_reviewer_profiles_ratio(spark, sf):
    return reviewer_profiles(_processed_ratio(spark, sf), "helpfulnessRatio")


def q_filter_min_rating(spark, sf):
    return _processed(spark, sf).where(min_rating(4.0))


def q_filter_min_length(spark, sf):
    return _processed(spark, sf).where(min_length(100))


def q_when_then_update(spark, sf):
    processed = _processed(spark, sf)
    flagged = mark_high_quality(processed, high_quality("votes"))
    # A second conditional update in the same call shape as the reference's test: long reviews
    # get their rating doubled; the predicate sees the original row.
    return when_then(flagged, F.col("reviewLength") > 100,
                     {"rating": F.col("rating") * F.lit(2.0)})


def q_transform_pipe(spark, sf):
    def keep_valid(df):
        return valid_reviews(df, "votes")

    def keep_quality(df):
        return df.where(quality(2.0, 10))

    return _raw(spark, sf).transform(pipe(keep_valid, keep_quality))


def q_safe_json_parse(spark, sf):
    events = sf_table(spark, sf, "events").select("event_id", "props")
    schema = T.StructType([T.StructField("k", T.LongType(), True)])
    return parse_json_column(events, "props", schema).select("event_id", "k", "malformed")


def q_percentile_event_value(spark, sf):
    """Nearly every event has a value of its own, so the ranges do split."""
    events = sf_table(spark, sf, "events").select("event_type", "value")
    return lower_percentile(events, "value", PERCENTILE, by="event_type", alias="valueP90")


def q_event_run_tags(spark, sf):
    events = sf_table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return tag_runs(events, key="event_type", order="event_id", partition_by="user_id")


# ---- sinks and sources: what is written is read back -----------------------------------------


def q_sink_roundtrip(spark, sf):
    """Product stats written as JSON and read back."""
    path = shared_path(spark, "product_stats")
    write_json(product_stats(_processed(spark, sf)), path)
    return spark.read.schema(PRODUCT_STATS).json(path)


def q_sink_ranked_parquet(spark, sf):
    """Ranked reviews written as Parquet by year and read back."""
    processed = _processed(spark, sf)
    ranked = rank_enriched(processed, product_stats(processed), "helpfulnessVotes")
    path = shared_path(spark, "ranked_reviews")
    write_parquet(ranked, path, partition_by=["year"])
    return spark.read.schema(ranked.schema).parquet(path).select(*ranked.columns)


def q_sink_profiles_json(spark, sf):
    """Reviewer profiles written as JSON and read back."""
    path = shared_path(spark, "reviewer_profiles")
    write_json(reviewer_profiles(_processed(spark, sf)), path)
    return spark.read.schema(PROFILE).json(path)


def _json_lines(reviews: DataFrame, schema: T.StructType) -> DataFrame:
    return reviews.select(
        F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("value"))


def _written_lines(lines: DataFrame) -> str:
    """Path of ``lines`` written as text files, gzipped: JSON repeats its field names in every line,
    so plain text takes many times the bytes of the tables it comes from."""
    path = shared_path(lines.sparkSession, "reviews-json")
    lines.write.option("maxRecordsPerFile", LINES_PER_FILE).text(path, compression="gzip")
    return path


def _json_reviews(spark, sf, schema: T.StructType = REVIEW, broken: bool = False) -> str:
    """All reviews as a source of JSON lines; with ``broken``, a line that is no JSON for each
    order among them."""
    lines = _json_lines(_raw(spark, sf), schema)
    if broken:
        keys = sf_table(spark, sf, "orders").select("o_orderkey")
        lines = lines.unionByName(keys.select(F.concat(
            F.lit(BROKEN_LINE), F.col("o_orderkey").cast("string")).alias("value")))
    return _written_lines(lines)


def q_json_reader(spark, sf):
    """The plain reader over all reviews as JSON lines."""
    return read_reviews(spark, _json_reviews(spark, sf))


def q_json_reader_missing(spark, sf):
    """The silent fallback: rows of a source that is there and of one that isn't."""
    path = _json_reviews(spark, sf)
    there = read_reviews(spark, path, on_missing="empty")
    missing = read_reviews(spark, f"{path}-none", on_missing="empty")
    count = lambda df, name: df.agg(F.lit(name).alias("source"),
                                    F.count(F.lit(1)).alias("n"))
    return count(there, "there").unionByName(count(missing, "missing"))


def q_json_product_stats(spark, sf):
    """All reviews read with quarantine; lines that are no JSON change nothing."""
    parsed, _ = read_reviews_checked(spark, _json_reviews(spark, sf, broken=True), REVIEW)
    return product_stats(process_reviews(parsed))


def q_json_malformed_lines(spark, sf):
    _, malformed = read_reviews_checked(spark, _json_reviews(spark, sf, broken=True), REVIEW)
    return malformed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- the whole job, from JSON lines to written tables ----------------------------------------


def _job(spark, sf, variant: str) -> str:
    out = shared_path(spark, f"job-{variant}")
    schema = REVIEW if variant == "votes" else REVIEW_RATIO
    run_job(spark, _json_reviews(spark, sf, schema, broken=True), out, variant)
    return out


def q_job_product_stats(spark, sf):
    return read_published(spark, _job(spark, sf, "votes"), "product_stats", PRODUCT_STATS)


def q_job_ranked_reviews(spark, sf):
    return read_published(spark, _job(spark, sf, "votes"), "ranked_reviews")


def q_job_reviewer_profiles(spark, sf):
    return read_published(spark, _job(spark, sf, "votes"), "reviewer_profiles", PROFILE)


def q_job_rejected(spark, sf):
    """Rejected reviews and malformed lines of one run, by reason."""
    out = _job(spark, sf, "votes")
    rejected = read_published(spark, out, "rejected_reviews").select("reason")
    return rejects_by_reason(rejected.unionByName(
        read_published(spark, out, "malformed_lines").select("reason")))


def q_job_ratio_product_stats(spark, sf):
    return read_published(spark, _job(spark, sf, "ratio"), "product_stats", PRODUCT_STATS_RATIO)


def q_job_ratio_ranked_reviews(spark, sf):
    return read_published(spark, _job(spark, sf, "ratio"), "ranked_reviews")


def q_job_ratio_reviewer_profiles(spark, sf):
    return read_published(spark, _job(spark, sf, "ratio"), "reviewer_profiles", PROFILE)


def q_job_cached_stats(spark, sf):
    """Product stats of the job with its tables kept; the same as without."""
    return build_outputs(_raw(spark, sf), "votes", cache="checkpoint").product_stats


QUERIES: dict[str, Query] = {
    "product_stats": q_product_stats,
    "reviews_adapter": q_reviews_adapter,
    "valid_reviews": q_valid_reviews,
    "rejected_reviews": q_rejected_reviews,
    "rejects_by_reason": q_rejects_by_reason,
    "rejects_by_reason_ratio": q_rejects_by_reason_ratio,
    "process_reviews": q_process_reviews,
    "dominant_sentiment": q_dominant_sentiment,
    "enrich_reviews": q_enrich_reviews,
    "enrich_self": q_enrich_self,
    "rank_reviews": q_rank_reviews,
    "reviewer_profiles": q_reviewer_profiles,
    "high_quality_count": q_high_quality_count,
    "high_quality_count_ratio": q_high_quality_count_ratio,
    "percentile_by_product": q_percentile_by_product,
    "percentile_global": q_percentile_global,
    "median_length_by_year": q_median_length_by_year,
    "event_runs_by_user": q_event_runs_by_user,
    "event_runs_global": q_event_runs_global,
    "event_runs_by_time": q_event_runs_by_time,
    "event_runs_tied_order": q_event_runs_tied_order,
    "conversation_role_runs": q_conversation_role_runs,
    "process_reviews_by_ratio": q_process_reviews_by_ratio,
    "product_stats_ratio": q_product_stats_ratio,
    "rank_reviews_ratio": q_rank_reviews_ratio,
    "reviewer_profiles_ratio": q_reviewer_profiles_ratio,
    "filter_min_rating": q_filter_min_rating,
    "filter_min_length": q_filter_min_length,
    "when_then_update": q_when_then_update,
    "transform_pipe": q_transform_pipe,
    "safe_json_parse": q_safe_json_parse,
    "percentile_event_value": q_percentile_event_value,
    "event_run_tags": q_event_run_tags,
    "sink_roundtrip": q_sink_roundtrip,
    "sink_ranked_parquet": q_sink_ranked_parquet,
    "sink_profiles_json": q_sink_profiles_json,
    "json_reader": q_json_reader,
    "json_reader_missing": q_json_reader_missing,
    "json_product_stats": q_json_product_stats,
    "json_malformed_lines": q_json_malformed_lines,
    "job_product_stats": q_job_product_stats,
    "job_ranked_reviews": q_job_ranked_reviews,
    "job_reviewer_profiles": q_job_reviewer_profiles,
    "job_rejected": q_job_rejected,
    "job_ratio_product_stats": q_job_ratio_product_stats,
    "job_ratio_ranked_reviews": q_job_ratio_ranked_reviews,
    "job_ratio_reviewer_profiles": q_job_ratio_reviewer_profiles,
    "job_cached_stats": q_job_cached_stats,
}
