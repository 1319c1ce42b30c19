import json
import os

from revspark.schemas import REVIEW
from revspark.streaming import (
    process_review_stream,
    product_stats_stream,
    read_review_stream,
    start_processed_sink,
)
from tests.conftest import raw_review


def _write(dir_, name, rows):
    with open(os.path.join(dir_, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_stream_processing_and_running_stats(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "a.json", [raw_review(reviewerID="u1", asin="p1", vote="20", overall=4.0),
                           raw_review(reviewerID="u2", asin="p1", vote="10", overall=2.0),
                           raw_review(reviewerID="u3", asin="p2", vote="1", overall=5.0),
                           raw_review(reviewerID="u4", asin="p2", reviewText=None)])
    raw = read_review_stream(spark, src, REVIEW)
    q = (product_stats_stream(process_review_stream(raw)).writeStream.format("memory")
         .queryName("stream_stats").outputMode("complete")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck1")).start())
    try:
        q.processAllAvailable()
        got = {tuple(r) for r in spark.sql("SELECT * FROM stream_stats").collect()}
        assert got == {("p1", 3.0, 2, 15.0)}
        _write(src, "b.json", [raw_review(reviewerID="u5", asin="p2", vote="30", overall=5.0)])
        q.processAllAvailable()
        got = {tuple(r) for r in spark.sql("SELECT * FROM stream_stats").collect()}
        assert got == {("p1", 3.0, 2, 15.0), ("p2", 5.0, 1, 30.0)}
    finally:
        q.stop()


def test_processed_file_sink(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "a.json", [raw_review(reviewerID=f"u{i}", vote=str(i)) for i in range(20)])
    out = os.path.join(tmp_dir, "out")
    q = start_processed_sink(read_review_stream(spark, src), out, available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 10


def test_rejected_stream_keeps_reasons(spark, tmp_dir):
    from revspark.streaming import rejected_review_stream

    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write(src, "a.json", [raw_review(reviewerID="ok"), raw_review(reviewerID="t", reviewText=None),
                           raw_review(reviewerID="r", overall=9.0)])
    q = (rejected_review_stream(read_review_stream(spark, src)).select("reviewerID", "reason")
         .writeStream.format("memory").queryName("stream_rejects").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).start())
    try:
        q.processAllAvailable()
        got = {tuple(r) for r in spark.sql("SELECT * FROM stream_rejects").collect()}
        assert got == {("t", "Review text is empty or missing"), ("r", "Invalid rating value")}
    finally:
        q.stop()
