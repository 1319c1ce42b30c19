from revspark.operators.aggregate import (
    count_where,
    dominant_sentiment,
    product_stats,
    reviewer_profiles,
)
from revspark.operators.join import enrich, enrich_self
from revspark.operators.percentile import lower_percentile
from revspark.operators.runs import consecutive_runs, summarize_runs, tag_runs, tag_runs_window
from revspark.operators.splitters import splitters, with_range
from revspark.operators.transform import mark_high_quality, pipe, when_then
from revspark.operators.validate import (
    classify,
    rejected_reviews,
    rejects_by_reason,
    valid_reviews,
)
from revspark.operators.window import rank_top_k

__all__ = [
    "classify",
    "consecutive_runs",
    "count_where",
    "dominant_sentiment",
    "enrich",
    "enrich_self",
    "lower_percentile",
    "mark_high_quality",
    "pipe",
    "product_stats",
    "rank_top_k",
    "rejected_reviews",
    "rejects_by_reason",
    "reviewer_profiles",
    "splitters",
    "summarize_runs",
    "tag_runs",
    "tag_runs_window",
    "valid_reviews",
    "when_then",
    "with_range",
]
