import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from revspark.operators.transform import mark_high_quality, pipe, when_then
from revspark.plans.job import build_outputs, run_job
from revspark.schemas import PRODUCT_STATS, PROFILE
from revspark.scratch import current, kept_table, scratch
from revspark.session import checkpoint_dir
from revspark.sources.adapter import reviews_from_tables
from revspark.sources.publish import published, read_published
from revspark.sources.reviews import read_review_lines, split_lines
from tests.conftest import SF_SMALL, as_set


def test_when_then_sees_the_original_row(spark):
    df = spark.createDataFrame([(4, 1), (3, 1)], "x int, y int")
    out = when_then(df, F.col("x") % 2 == 0, {"x": F.col("x") * 2, "y": F.col("x")})
    assert as_set(out) == {(8, 4), (3, 1)}


def test_when_then_doubles_rating_of_long_reviews(spark):
    df = spark.createDataFrame([(4.5, 50), (4.5, 150)], "rating double, reviewLength int")
    out = when_then(df, F.col("reviewLength") > 100, {"rating": F.col("rating") * 2})
    assert as_set(out) == {(4.5, 50), (9.0, 150)}


def test_mark_high_quality_adds_flag(spark):
    df = spark.createDataFrame([(4.0, 100), (4.0, 99)], "rating double, reviewLength int")
    assert as_set(mark_high_quality(df)) == {(4.0, 100, True), (4.0, 99, False)}


def test_pipe_composes_left_to_right(spark):
    df = spark.createDataFrame([(5,)], "x int")
    add_one = lambda d: d.select((F.col("x") + 1).alias("x"))
    double = lambda d: d.select((F.col("x") * 2).alias("x"))
    assert df.transform(pipe(add_one, double)).collect()[0].x == 12


def test_job_outputs_on_tables(spark):
    raw = reviews_from_tables(spark, SF_SMALL)
    for variant in ("votes", "ratio"):
        out = build_outputs(raw, variant)
        n = out.processed.count()
        assert n > 0
        assert out.product_stats.agg(F.sum("reviewCount")).collect()[0][0] == n
        assert out.reviewer_profiles.agg(F.sum("totalReviews")).collect()[0][0] == n
        assert out.enriched.count() == n
        hq = out.high_quality_count.collect()[0][0]
        assert 0 < hq < n
        ranks = out.ranked_reviews.groupBy("year").agg(F.min("helpfulnessRank").alias("m"))
        assert {r.m for r in ranks.collect()} == {1}


def test_run_job_writes_outputs(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    raw = reviews_from_tables(spark, SF_SMALL).drop("helpful")
    raw.write.json(src)
    out = os.path.join(tmp_dir, "out")
    count = run_job(spark, src, out)
    stats = read_published(spark, out, "product_stats", PRODUCT_STATS)
    expected = build_outputs(raw, "votes")
    assert as_set(stats) == as_set(expected.product_stats)
    assert read_published(spark, out, "ranked_reviews").count() == expected.ranked_reviews.count()
    profiles = read_published(spark, out, "reviewer_profiles", PROFILE)
    assert as_set(profiles) == as_set(expected.reviewer_profiles)
    assert count == expected.high_quality_count.collect()[0][0]
    rejected = read_published(spark, out, "rejected_reviews")
    assert rejected.count() + expected.processed.count() <= raw.count()


def test_run_job_on_missing_input(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    assert run_job(spark, os.path.join(tmp_dir, "absent"), out, on_missing="empty") == 0
    assert read_published(spark, out, "product_stats", PRODUCT_STATS).count() == 0


def test_null_product_written_and_read_back(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.json")
    rows = [{"reviewerID": "u", "overall": 4.0, "vote": "20", "reviewText": "ok",
             "unixReviewTime": 1577000000}]
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    out = os.path.join(tmp_dir, "out")
    run_job(spark, path, out)
    stats = read_published(spark, out, "product_stats", PRODUCT_STATS).collect()
    assert [(r.productID, r.reviewCount) for r in stats] == [(None, 1)]
    assert read_published(spark, out, "ranked_reviews").count() == 0


def test_cli_runs_the_job(spark, tmp_dir, capsys):
    from revspark.__main__ import main

    src = os.path.join(tmp_dir, "in")
    reviews_from_tables(spark, SF_SMALL).drop("helpful").write.json(src)
    out = os.path.join(tmp_dir, "out")
    assert main([src, out, "--partition-ranked-by-year"]) == 0
    assert "Total high-quality reviews:" in capsys.readouterr().out
    assert read_published(spark, out, "ranked_reviews").select("year").distinct().count() > 1


def test_scale_conf_sizes_partitions():
    from revspark.session import scale_conf

    assert scale_conf(0)["spark.sql.shuffle.partitions"] == "1"
    assert scale_conf(1 << 30)["spark.sql.shuffle.partitions"] == "4"
    assert scale_conf(100 << 40)["spark.sql.shuffle.partitions"] == "409600"


def test_checkpointed_job_equals_recomputed(spark, tmp_dir):
    raw = reviews_from_tables(spark, SF_SMALL)
    plain = build_outputs(raw, "votes")
    ck = build_outputs(raw, "votes", cache="checkpoint")
    assert ck.classified.inputFiles() and all("scratch-classified" in f
                                              for f in ck.classified.inputFiles())
    assert as_set(ck.product_stats) == as_set(plain.product_stats)
    assert as_set(ck.ranked_reviews) == as_set(plain.ranked_reviews)
    assert ck.high_quality_count.collect() == plain.high_quality_count.collect()


def test_run_job_quarantines_malformed_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.json")
    good = {"reviewerID": "u", "asin": "p", "overall": 4.0, "vote": "20", "reviewText": "ok",
            "unixReviewTime": 1577000000}
    with open(path, "w") as f:
        f.write("\n".join([json.dumps(good), "{broken", "", json.dumps(good)]))
    out = os.path.join(tmp_dir, "out")
    run_job(spark, path, out)
    stats = read_published(spark, out, "product_stats", PRODUCT_STATS).collect()
    assert [(r.productID, r.reviewCount) for r in stats] == [("p", 2)]
    bad = read_published(spark, out, "malformed_lines").collect()
    assert [(r.line, r.reason) for r in bad] == [("{broken", "Malformed record")]
    assert read_published(spark, out, "rejected_reviews").count() == 0


def test_run_job_reads_its_input_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    reviews_from_tables(spark, SF_SMALL).drop("helpful").write.json(src)
    raw, _ = split_lines(read_review_lines(spark, src))
    out = build_outputs(raw, "votes", cache="persist")
    try:
        for df in (out.rejected, out.product_stats, out.ranked_reviews, out.reviewer_profiles):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "InMemoryRelation" in plan
        text = out.classified._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json") == 1
    finally:
        out.unpersist()
    assert not out.classified.is_cached and not out.product_stats.is_cached


def test_cached_job_equals_recomputed(spark):
    raw = reviews_from_tables(spark, SF_SMALL)
    plain, kept = build_outputs(raw, "ratio"), build_outputs(raw, "ratio", cache="persist")
    try:
        for name in ("rejected", "product_stats", "enriched", "ranked_reviews",
                     "reviewer_profiles"):
            a, b = getattr(plain, name), getattr(kept, name)
            cols = [c for c in a.columns if c not in ("image", "helpful")]
            assert as_set(a, *cols) == as_set(b, *cols)
    finally:
        kept.unpersist()


def test_size_shuffle_from_input(spark, tmp_dir):
    from revspark.session import input_bytes, size_shuffle_for

    src = os.path.join(tmp_dir, "in")
    reviews_from_tables(spark, SF_SMALL).drop("helpful").write.json(src)
    assert input_bytes(spark, src) > 0
    from revspark.session import scale_conf

    keys = list(scale_conf(0))
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        conf = size_shuffle_for(spark, src)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf[
            "spark.sql.shuffle.partitions"] == "1"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def left_in_scratch(spark):
    """What lies in the shared folder, and the tables of the catalog."""
    base = checkpoint_dir(spark).removeprefix("file:")
    return set(os.listdir(base)), {t.name for t in spark.catalog.listTables()}


def test_scopes_remove_what_was_written_in_them(spark):
    before = left_in_scratch(spark)
    with scratch(spark) as outer:
        kept = kept_table(spark.range(10).toDF("x"), "outer")
        with scratch(spark):
            inner = kept_table(spark.range(5).toDF("x"), "inner")
            assert inner.count() == 5 and len(left_in_scratch(spark)[0] - before[0]) == 2
            name = current(spark).table("rows")
            spark.range(3).write.format("parquet").option(
                "path", current(spark).path("rows")).saveAsTable(name)
            assert spark.table(name).count() == 3
        assert kept.count() == 10 and current(spark) is outer
        assert len(left_in_scratch(spark)[0] - before[0]) == 1
    assert left_in_scratch(spark) == before


def test_scopes_remove_tables_on_failure(spark):
    before = left_in_scratch(spark)
    for broken in (False, True):
        try:
            with scratch(spark):
                kept_table(spark.range(10).toDF("x"), "t")
                if broken:
                    spark.range(3).selectExpr("raise_error('stop')").collect()
        except Exception as exc:
            assert broken and "stop" in str(exc)
        assert left_in_scratch(spark) == before


def reviews_source(spark, folder, n=40):
    path = os.path.join(folder, f"reviews-{n}.json")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(
            {"reviewerID": f"u{i % 7}", "asin": f"p{i % 5}", "overall": 4.0, "vote": "20",
             "reviewText": "a fine kettle", "unixReviewTime": 1577000000 + i}) for i in range(n)))
    return path


def totals(spark, out):
    """Number of reviews that each published table tells of."""
    stats = read_published(spark, out, "product_stats", PRODUCT_STATS)
    profiles = read_published(spark, out, "reviewer_profiles", PROFILE)
    return (stats.agg(F.sum("reviewCount")).first()[0],
            read_published(spark, out, "ranked_reviews").count(),
            profiles.agg(F.sum("totalReviews")).first()[0])


def test_a_job_leaves_nothing_but_its_outputs(spark, tmp_dir):
    before = left_in_scratch(spark)
    out = os.path.join(tmp_dir, "out")
    run_job(spark, reviews_source(spark, tmp_dir), out)
    assert left_in_scratch(spark) == before
    assert totals(spark, out) == (40, 40, 40)


def test_a_failing_sink_leaves_the_previous_run_published(spark, tmp_dir, monkeypatch):
    from revspark.plans import job

    out, before = os.path.join(tmp_dir, "out"), left_in_scratch(spark)
    run_job(spark, reviews_source(spark, tmp_dir, 40), out)
    first = published(spark, out)

    def fail(*args, **kwargs):
        raise OSError("disk is gone")

    monkeypatch.setattr(job, "write_parquet", fail)  # product_stats is written by then
    try:
        run_job(spark, reviews_source(spark, tmp_dir, 55), out)
        raise AssertionError("the sink should have failed")
    except OSError:
        pass
    monkeypatch.undo()
    assert published(spark, out) == first and totals(spark, out) == (40, 40, 40)
    assert left_in_scratch(spark) == before
    run_job(spark, reviews_source(spark, tmp_dir, 70), out)
    assert totals(spark, out) == (70, 70, 70)
    # The failed run's folder is gone, the previous run's is still there for its readers.
    assert len(os.listdir(os.path.join(out, "runs"))) == 2


KILLED = """
import os, sys
from revspark.plans import job
from revspark.session import get_spark
whole = job.write_json
def dying(df, path, mode="overwrite"):
    if path.endswith("reviewer_profiles"):
        os._exit(9)
    whole(df, path, mode)
job.write_json = dying
job.run_job(get_spark("local[2]", shuffle_partitions=2, conf={"spark.checkpoint.dir": sys.argv[3]}),
            sys.argv[1], sys.argv[2])
"""


def test_a_job_killed_between_two_sinks_leaves_the_previous_run_whole(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    run_job(spark, reviews_source(spark, tmp_dir, 40), out)
    first = published(spark, out)
    source = reviews_source(spark, tmp_dir, 55)
    done = subprocess.run([sys.executable, "-c", KILLED, source, out, os.path.join(tmp_dir, "ck")],
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                          capture_output=True, timeout=300)
    assert done.returncode == 9
    runs = os.listdir(os.path.join(out, "runs"))
    dead = next(r for r in runs if not first["product_stats"].split("/")[-2] == r)
    assert set(os.listdir(os.path.join(out, "runs", dead))) == {"product_stats", "ranked_reviews"}
    assert published(spark, out) == first and totals(spark, out) == (40, 40, 40)


def test_manifest_is_replaced_at_once_and_absent_before_the_first_run(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    assert published(spark, out) == {}
    for n in (1, 2, 3):
        run_job(spark, reviews_source(spark, tmp_dir, n), out)
        assert totals(spark, out) == (n, n, n)
        names = os.listdir(out)
        assert [x for x in names if not x.endswith(".crc")].count("_manifest.json") == 1
        assert not any(x.startswith("_manifest.json.") and not x.endswith(".crc") for x in names)
