from revspark.streaming.reviews import (
    process_review_stream,
    product_stats_stream,
    read_review_stream,
    rejected_review_stream,
    start_processed_sink,
)

__all__ = [
    "process_review_stream",
    "product_stats_stream",
    "read_review_stream",
    "rejected_review_stream",
    "start_processed_sink",
]
