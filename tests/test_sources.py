import datetime
import json
import os
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.operators.validate import MALFORMED
from revspark.plans import queries
from revspark.plans.process import process_reviews
from revspark.schemas import REVIEW
from revspark.scratch import scratch
from revspark.session import input_bytes
from revspark.sources import parse_json_column, read_reviews, read_reviews_checked
from tests.conftest import as_set, raw_df, raw_review

KETTLES = [
    {"reviewerID": "R-301", "asin": "KETTLE-7", "reviewerName": "Ilse", "overall": 2.5,
     "unixReviewTime": 1388576400, "reviewTime": "01 01, 2014", "reviewText": "Drips when full.",
     "vote": "41", "image": ["front.jpg"], "summary": "Leaky", "verified": False},
    {"reviewerID": "R-302", "asin": "LAMP-2", "reviewerName": "Tomas", "overall": 4.5,
     "unixReviewTime": 1526391000, "reviewTime": "05 15, 2018", "reviewText": "Warm light, firm base.",
     "vote": "8", "image": [], "summary": "Solid", "verified": True},
    {"reviewerID": "R-303", "asin": "KETTLE-7", "overall": 1.0, "unixReviewTime": 1400000000,
     "reviewText": "Arrived dented."},
]


def write_lines(tmp_dir, lines):
    path = os.path.join(tmp_dir, "reviews.json")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_loader_reads_rows_and_skips_blank_line(spark, tmp_dir):
    path = write_lines(tmp_dir, ["", json.dumps(KETTLES[0]), " ", *map(json.dumps, KETTLES[1:])])
    df = read_reviews(spark, path)
    assert df.schema == REVIEW
    assert as_set(df, "reviewerID", "asin", "overall", "vote") == {
        ("R-301", "KETTLE-7", 2.5, "41"), ("R-302", "LAMP-2", 4.5, "8"),
        ("R-303", "KETTLE-7", 1.0, None)}


def test_missing_path(spark, tmp_dir):
    missing = os.path.join(tmp_dir, "nope.json")
    with pytest.raises(AnalysisException):
        read_reviews(spark, missing)
    empty = read_reviews(spark, missing, on_missing="empty")
    assert empty.count() == 0 and empty.schema == REVIEW


def test_absent_field_reads_as_null(spark, tmp_dir):
    path = write_lines(tmp_dir, [json.dumps({"reviewerID": "x", "overall": 4.0})])
    row = read_reviews(spark, path).collect()[0]
    assert row.reviewerID == "x" and row.vote is None and row.unixReviewTime is None


def test_quarantine_keeps_every_bad_line(spark, tmp_dir):
    good = json.dumps(KETTLES[0])
    bad = ['{"reviewerID": "x", "overall": "bad"}', "not json at all", "[1, 2, 3]",
           good[: len(good) // 2]]
    path = write_lines(tmp_dir, ["", good, "   "] + bad)
    parsed, malformed = read_reviews_checked(spark, path)
    assert parsed.count() == 1
    assert malformed.count() == 4
    assert {r.reason for r in malformed.collect()} == {MALFORMED}
    # the same rows are flagged whichever columns a query asks for
    assert parsed.select("reviewerID").count() == 1


def test_parse_json_column(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "oops"), (3, None), (4, '{"k": "x"}')],
                               "id long, props string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    got = as_set(parse_json_column(df, "props", schema), "id", "k", "malformed")
    assert got == {(1, 3, False), (2, None, True), (3, None, True), (4, None, True)}


def test_unknown_and_absent_fields_are_not_malformed(spark, tmp_dir):
    line = json.dumps({"reviewerID": "x", "overall": 4.0, "somethingElse": [1, 2]})
    path = write_lines(tmp_dir, [line])
    parsed, malformed = read_reviews_checked(spark, path)
    assert malformed.count() == 0
    row = parsed.collect()[0]
    assert row.reviewerID == "x" and row.vote is None


def test_checked_reader_on_missing_path(spark, tmp_dir):
    missing = os.path.join(tmp_dir, "absent")
    with pytest.raises(AnalysisException):
        read_reviews_checked(spark, missing)
    parsed, malformed = read_reviews_checked(spark, missing, on_missing="empty")
    assert parsed.count() == 0 and malformed.count() == 0
    assert malformed.columns == ["line", "reason"]


def test_a_line_is_parsed_once(spark, tmp_dir):
    path = write_lines(tmp_dir, [json.dumps(r) for r in KETTLES])
    parsed, _ = read_reviews_checked(spark, path)
    plan = process_reviews(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_null_and_odd_json_lines_are_malformed(spark, tmp_dir):
    path = write_lines(tmp_dir, ["null", "12", '"text"', "{}", json.dumps(KETTLES[1])])
    parsed, malformed = read_reviews_checked(spark, path)
    assert parsed.count() + malformed.count() == 5
    assert {r.line for r in malformed.collect()} >= {"12", '"text"'}


def test_malformed_option(spark, tmp_dir):
    with pytest.raises(ValueError):
        read_reviews_checked(spark, tmp_dir, on_missing="maybe")


def test_json_source_of_the_queries_is_small_and_whole(spark, monkeypatch):
    """Every line once, in files that stay small as they can't be split, in far fewer bytes."""
    monkeypatch.setattr(queries, "LINES_PER_FILE", 300)
    rnd = random.Random(5)
    rows = [raw_review(reviewerID=f"U{i}", reviewText=f"kettle {rnd.random()} \U0001F600" * 3)
            for i in range(1000)]
    lines = queries._json_lines(raw_df(spark, rows), REVIEW).unionByName(
        spark.createDataFrame([("order 7",)], "value string"))
    want = sorted(r["value"] for r in lines.collect())
    with scratch(spark):
        path = queries._written_lines(lines.coalesce(1))
        assert sorted(r["value"] for r in spark.read.text(path).collect()) == want
        files = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
        assert len(files) == 4 and max(r["count"] for r in files) == 300
        assert input_bytes(spark, path) < sum(len(x.encode()) + 1 for x in want) / 3


JSON_QUERIES = [
    "job_ranked_reviews",
    "job_reviewer_profiles",
    "job_rejected",
    "json_reader",
    "job_ratio_product_stats",
    "job_ratio_reviewer_profiles",
    "job_ratio_ranked_reviews",
    "json_product_stats",
    "json_malformed_lines",
]


@pytest.fixture(scope="module")
def review_tables(spark, tmp_path_factory):
    """1,000 orders of two line items each."""
    rnd, sf = random.Random(9), str(tmp_path_factory.mktemp("tables"))
    day = datetime.datetime(2021, 3, 4)
    spark.createDataFrame(
        [(o, rnd.randrange(300), rnd.choice("FOP")) for o in range(1000)],
        "o_orderkey long, o_custkey long, o_orderstatus string",
    ).write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame(
        [(o, rnd.randrange(200), n, float(rnd.randrange(1, 51)), rnd.choice("ANR"),
          day + datetime.timedelta(days=rnd.randrange(900))) for o in range(1000) for n in (1, 2)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
        "l_returnflag string, l_shipdate timestamp",
    ).coalesce(1).write.parquet(f"{sf}/lineitem.parquet")
    return sf


@pytest.mark.parametrize("name", JSON_QUERIES)
def test_query_writes_its_json_source_whole_in_few_bytes(spark, review_tables, name):
    broken = 0 if name == "json_reader" else 1000  # a line for each order
    with scratch(spark) as scope:
        queries.QUERIES[name](spark, review_tables).collect()
        (path,) = [p for p in scope.paths if "reviews-json" in p]
        lines = [r["value"] for r in spark.read.text(path).collect()]
        assert len(lines) == 2000 + broken
        assert len([x for x in lines if x.startswith(queries.BROKEN_LINE)]) == broken
        assert input_bytes(spark, path) < sum(len(x.encode()) + 1 for x in lines) / 3
