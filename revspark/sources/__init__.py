from revspark.sources.adapter import reviews_from_tables
from revspark.sources.publish import publish, published, read_published
from revspark.sources.reviews import (
    parse_json_column,
    read_review_lines,
    read_reviews,
    read_reviews_checked,
    split_lines,
)
from revspark.sources.sinks import persist, write_json, write_parquet

__all__ = [
    "parse_json_column",
    "persist",
    "publish",
    "published",
    "read_published",
    "read_review_lines",
    "read_reviews",
    "read_reviews_checked",
    "reviews_from_tables",
    "split_lines",
    "write_json",
    "write_parquet",
]
