import pytest
from pyspark.sql import functions as F

from revspark.operators.transform import when_then
from revspark.operators.window import rank_top_k
from revspark.scratch import shared_path
from revspark.session import checkpoint_dir
from tests.conftest import as_set


def test_rank_custom_partition_order_and_k(spark):
    rows = [("a", 1, 5.0), ("a", 2, 7.0), ("a", 3, 7.0), ("b", 4, 1.0), ("b", 5, 2.0)]
    df = spark.createDataFrame(rows, "g string, id int, x double")
    out = rank_top_k(df, partition_by=["g"], order_by=["x", "id"], k=1, rank_column="r",
                     descending=[True, False])
    assert as_set(out, "g", "id", "r") == {("a", 2, 1), ("b", 5, 1)}
    tied = rank_top_k(df, partition_by="g", order_by="x", k=1, rank_column="r")
    assert as_set(tied, "g", "id") == {("a", 2), ("a", 3), ("b", 5)}
    with pytest.raises(ValueError):
        rank_top_k(df, k=0)


def test_when_then_null_predicate_leaves_row(spark):
    df = spark.createDataFrame([(None, 1), (5, 1)], "x int, y int")
    out = when_then(df, F.col("x") > 3, {"y": F.lit(9)})
    assert as_set(out) == {(None, 1), (5, 9)}


def test_checkpoint_folder_is_read_from_the_session(spark):
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    assert spark.conf.get("spark.checkpoint.dir") in base
    a, b = shared_path(spark, "t"), shared_path(spark, "t")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.integers(2019, 2021), st.integers(0, 6)), max_size=40),
       k=st.integers(1, 5))
def test_rank_top_k_property(spark, rows, k):
    data = [(i, y, v) for i, (y, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, year int, helpfulnessVotes int")
    got = {(r.id, r.helpfulnessRank) for r in rank_top_k(df, k=k).collect()}
    expected = set()
    for i, y, v in data:
        rank = 1 + sum(1 for _, y2, v2 in data if y2 == y and v2 > v)
        if rank <= k:
            expected.add((i, rank))
    assert got == expected


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]),
                               st.sampled_from(["p1", "p2", None]),
                               st.sampled_from([1.0, 2.5, 4.0, 5.0]),
                               st.integers(0, 50), st.integers(0, 300)),
                     min_size=1, max_size=30))
def test_aggregates_property(spark, rows):
    from revspark.operators.aggregate import product_stats, reviewer_profiles
    from revspark.schemas import PROCESSED

    df = spark.createDataFrame([(u, p, r, v, n, "x", 2021, False) for u, p, r, v, n in rows],
                               PROCESSED)
    stats = {r.productID: r for r in product_stats(df).collect()}
    for p in {row[1] for row in rows}:
        g = [row for row in rows if row[1] == p]
        s = stats[p]
        assert s.reviewCount == len(g)
        assert s.avgRating == pytest.approx(sum(x[2] for x in g) / len(g))
        assert s.avgHelpfulness == pytest.approx(sum(x[3] for x in g) / len(g))
    profiles = {r.reviewerID: r for r in reviewer_profiles(df).collect()}
    for u in {row[0] for row in rows}:
        g = [row for row in rows if row[0] == u]
        q = profiles[u]
        assert q.totalReviews == len(g)
        assert q.avgReviewLength == pytest.approx(sum(x[4] for x in g) / len(g))
        assert q.helpfulnessScore == pytest.approx(sum(x[3] for x in g) / len(g))
