"""The same plans on streaming DataFrames (Structured Streaming).

Validation and processing are per-row expressions, so they apply to a stream unchanged; product
statistics become a stateful streaming aggregate whose state Spark keeps in the checkpoint
(one row of partial sums per product). Streams need a checkpoint location: by default a new
folder under the session's shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revspark.operators.aggregate import product_stats
from revspark.operators.validate import rejected_reviews, variant_of
from revspark.plans.process import process_reviews, process_reviews_by_ratio
from revspark.schemas import REVIEW
from revspark.scratch import shared_path


def read_review_stream(spark: SparkSession, path: str, schema: T.StructType = REVIEW,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """New JSON-lines files arriving in ``path``, read with the declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.json(path)


def process_review_stream(raw: DataFrame, variant: str = "votes") -> DataFrame:
    """Processed reviews of a stream (stateless: validation, projection, quality filter)."""
    if variant_of(variant).name == "votes":
        return process_reviews(raw)
    return process_reviews_by_ratio(raw)


def rejected_review_stream(raw: DataFrame, variant: str = "votes") -> DataFrame:
    return rejected_reviews(raw, variant)


def product_stats_stream(processed: DataFrame, variant: str = "votes") -> DataFrame:
    """Running per-product statistics; write with output mode "update" or "complete"."""
    return product_stats(processed, variant_of(variant).helpfulness_column)


def start_processed_sink(raw: DataFrame, output_path: str, variant: str = "votes",
                         checkpoint_location: str | None = None,
                         available_now: bool = False) -> StreamingQuery:
    """Append processed reviews to a Parquet folder; the file sink with a checkpoint commits
    each micro-batch exactly once, so a restarted query neither loses nor repeats rows."""
    spark = raw.sparkSession
    writer = (
        process_review_stream(raw, variant)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_location or shared_path(spark, "stream-ckpt"))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
