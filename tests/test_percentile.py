import random

import pytest

from revspark.operators.percentile import lower_percentile


def list_percentile(values, p):
    """The list definition: sorted values, index floor(p/100 * (n - 1)); empty -> 0.0."""
    if not values:
        return 0.0
    s = sorted(values)
    return s[int((p / 100.0) * (len(s) - 1))]


def one(spark, values, p, kind="double", **kw):
    cast = float if kind == "double" else int
    df = spark.createDataFrame([(cast(v),) for v in values], f"x {kind}")
    return lower_percentile(df, "x", p, **kw).collect()[0][0]


def test_small_lists(spark):
    values = [11, -4, 7, 7, 30, 2, 18]
    assert [one(spark, values, p) for p in (0, 16, 17, 50, 99, 100)] == [-4, -4, 2, 7, 18, 30]
    assert one(spark, [-6.5], 73) == -6.5
    assert one(spark, [], 20) == 0.0


def test_differs_from_builtins_where_the_definition_does(spark):
    assert one(spark, [1, 2, 3, 4], 90) == 3.0


def test_out_of_range_percentile(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        lower_percentile(df, "x", 101)
    with pytest.raises(ValueError):
        lower_percentile(df, "x", -1)


@pytest.mark.parametrize("ranges", [1, 3, 8, 200])
def test_grouped_against_brute_force(spark, ranges):
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        n = rnd.choice([1, 2, 5, 40, 300])
        for _ in range(n):
            rows.append((None if g == 11 else f"g{g}", float(rnd.randint(-50, 50)) / 4))
    rows.append(("g0", None))
    df = spark.createDataFrame(rows, "g string, x double")
    for p in (0, 37.5, 50, 90, 100):
        got = {r[0]: r[1] for r in lower_percentile(df, "x", p, by="g", ranges=ranges).collect()}
        groups = {}
        for g, x in rows:
            if x is not None:
                groups.setdefault(g, []).append(x)
        assert got == {g: list_percentile(v, p) for g, v in groups.items()}
        glob = lower_percentile(df, "x", p, ranges=ranges).collect()[0][0]
        assert glob == list_percentile([x for _, x in rows if x is not None], p)


def test_skewed_group_with_crowded_distinct_values(spark):
    rnd = random.Random(3)
    hot = [rnd.random() ** 8 * 1000 for _ in range(3000)]  # crowded near 0, sparse near 1000
    rows = [("hot", x) for x in hot] + [(f"c{i}", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, x double")
    for p in (1, 50, 75, 99):
        got = {r[0]: r[1] for r in lower_percentile(df, "x", p, by="g", ranges=60).collect()}
        assert got["hot"] == list_percentile(hot, p)
        assert got["c5"] == 5.0


def test_large_integers_stay_exact(spark):
    values = [2**60 + i for i in range(11)]
    assert one(spark, values, 50, "long", ranges=4) == 2**60 + 5


def test_nan_and_infinite_values_sort_last(spark):
    values = [float("nan"), float("inf"), 1.0, float("-inf"), 2.0]
    got = [one(spark, values, p, ranges=3) for p in (0, 25, 50, 75)]
    assert got == [float("-inf"), 1.0, 2.0, float("inf")]
    assert repr(one(spark, values, 100, ranges=3)) == "nan"


def test_no_cross_join(spark):
    df = spark.range(100).selectExpr("cast(id AS double) AS x", "id % 3 AS g")
    for by in ((), "g"):
        plan = lower_percentile(df, "x", 50, by=by)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_groups_over_many_ranges_equal_brute_force(spark):
    rnd = random.Random(21)
    for ranges in (2, 5, 17, 64):
        rows = [(rnd.choice([None, 1, 2, 2, 2, 2, 3]), rnd.choice(["x", None]), rnd.randint(0, 400))
                for _ in range(1500)]
        df = spark.createDataFrame(rows, "g long, h string, x int")
        groups = {}
        for g, h, x in rows:
            groups.setdefault((g, h), []).append(x)
        for p in (0, 33, 50, 100):
            got = lower_percentile(df, "x", p, by=["g", "h"], ranges=ranges).collect()
            assert {(r.g, r.h): r.percentile for r in got} == {
                k: list_percentile(v, p) for k, v in groups.items()}
            assert len(got) == len(groups)


def test_values_that_are_no_numbers(spark):
    words = ["pear", "fig", "apple", "kiwi", "fig"]
    df = spark.createDataFrame([(w,) for w in words], "x string")
    assert [lower_percentile(df, "x", p, ranges=3).first()[0] for p in (0, 50, 99, 100)] == [
        "apple", "fig", "kiwi", "pear"]
    assert lower_percentile(df.where("x = '-'"), "x", 50).first()[0] is None


def test_no_job_runs_while_the_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(100).selectExpr("cast(id AS double) AS x", "id % 3 AS g")
    spark.sparkContext.setJobGroup("build-percentile", "plan only")
    try:
        lower_percentile(df, "x", 50, by="g").explain()
        assert not tracker.getJobIdsForGroup("build-percentile")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
