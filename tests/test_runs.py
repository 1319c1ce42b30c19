import random

import pytest

from revspark.operators.runs import (
    consecutive_runs,
    summarize_runs,
    tag_runs,
    tag_runs_window,
)
from revspark.operators.splitters import range_count, splitters, with_range
from tests.conftest import SF_SMALL, as_set


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        "user_id", "event_id", "event_type")


@pytest.mark.parametrize("ranges", [1, 2, 4, 9])
def test_runs_of_a_short_list(spark, ranges):
    df = spark.createDataFrame([(10 * i, k) for i, k in enumerate("ccaccccbb")], "pos long, k string")
    got = sorted(as_set(consecutive_runs(df, "k", "pos", ranges=ranges)))
    assert got == [(1, "c", 0, 10, 2), (2, "a", 20, 20, 1), (3, "c", 30, 60, 4), (4, "b", 70, 80, 2)]


def test_null_keys_compare_equal(spark):
    keys = [None, None, "A", None, "A", "A"]
    df = spark.createDataFrame(list(enumerate(keys)), "pos long, k string")
    got = sorted(as_set(consecutive_runs(df, "k", "pos", ranges=6), "run_id", "run_len"))
    assert got == [(1, 2), (2, 1), (3, 1), (4, 2)]


@pytest.mark.parametrize("ranges", [1, 2, 7, 60])
def test_equals_the_plain_window_on_events(spark, ranges):
    df = events(spark)
    for part in ((), "user_id"):
        plain = tag_runs_window(df, "event_type", "event_id", part)
        assert as_set(tag_runs(df, "event_type", "event_id", part, ranges)) == as_set(plain)
        runs = consecutive_runs(df, "event_type", "event_id", part, ranges)
        assert as_set(runs) == as_set(summarize_runs(plain, "event_type", "event_id", part),
                                      *runs.columns)


def test_hot_partition_key_with_sparse_nulls(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(2000):
        user = 0 if rnd.random() < 0.4 else (None if rnd.random() < 0.1 else rnd.randint(1, 30))
        rows.append((i * 3, user, rnd.choice(["a", "b", None])))
    df = spark.createDataFrame(rows, "ord long, user long, k string")
    plain = summarize_runs(tag_runs_window(df, "k", "ord", "user"), "k", "ord", "user")
    fast = consecutive_runs(df, "k", "ord", "user", ranges=40)
    assert as_set(fast) == as_set(plain, *fast.columns)


def test_multi_column_order(spark):
    rows = [(i // 4, i % 4, "x" if (i // 5) % 2 else "y") for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b long, k string")
    plain = tag_runs_window(df, "k", ["a", "b"])
    assert as_set(tag_runs(df, "k", ["a", "b"], ranges=16)) == as_set(plain)
    fast = consecutive_runs(df, "k", ["a", "b"], ranges=16)
    assert as_set(fast) == as_set(summarize_runs(plain, "k", ["a", "b"]), *fast.columns)


def test_one_run_over_all_buckets(spark):
    df = spark.range(500).selectExpr("id AS pos", "'same' AS k")
    assert as_set(consecutive_runs(df, "k", "pos", ranges=20)) == {(1, "same", 0, 499, 500)}


def test_default_ranges_are_a_few_for_each_shuffle_partition(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_count(events(spark)) == 4 * n


def test_no_job_runs_while_the_plan_is_built(spark):
    tracker, df = spark.sparkContext.statusTracker(), events(spark)  # reading a footer is a job
    spark.sparkContext.setJobGroup("build", "plan only")
    try:
        consecutive_runs(df, "event_type", "event_id", "user_id").explain()
        tag_runs(df, "event_type", "event_id")
        assert not tracker.getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_empty_input(spark):
    df = spark.createDataFrame([], "pos long, k string")
    assert tag_runs(df, "k", "pos").count() == 0
    assert consecutive_runs(df, "k", "pos").count() == 0


@pytest.mark.parametrize("ranges", [1, 5])
def test_null_order_values_keep_their_rows(spark, ranges):
    rows = [(None, "a"), (None, "a"), (1, "a"), (2, "b"), (None, "a"), (40, "b")]
    df = spark.createDataFrame(rows, "pos long, k string")
    fast = tag_runs(df, "k", "pos", ranges=ranges)
    assert fast.count() == 6
    assert as_set(fast) == as_set(tag_runs_window(df, "k", "pos"))


def sizes(df, order, n):
    ranged = with_range(df, "r", order, splitters(df, order, n), n)
    return [r[1] for r in ranged.groupBy("r").count().collect()]


def test_ranges_split_a_dense_stretch(spark):
    rnd = random.Random(5)
    # a third of the rows packed into a tiny stretch of a wide, sparse id range
    ids = set(rnd.sample(range(0, 10**12), 1200)) | set(range(5 * 10**11, 5 * 10**11 + 600))
    df = spark.createDataFrame([(i, rnd.choice("xy")) for i in sorted(ids)], "pos long, k string")
    found = sizes(df, ["pos"], 18)
    assert len(found) >= 12 and max(found) <= 250
    fast = tag_runs(df, "k", "pos", ranges=18)
    assert as_set(fast) == as_set(tag_runs_window(df, "k", "pos"))


def test_ranges_split_rows_tied_in_the_first_order_column(spark):
    rnd = random.Random(9)
    rows = [(7 if i % 10 else i, i, rnd.choice("xyz")) for i in range(3000)]
    df = spark.createDataFrame(rows, "tied long, id long, k string")
    found = sizes(df, ["tied", "id"], 20)
    assert len(found) >= 15 and max(found) <= 450
    plain = tag_runs_window(df, "k", ["tied", "id"])
    assert as_set(tag_runs(df, "k", ["tied", "id"], ranges=20)) == as_set(plain)
    fast = consecutive_runs(df, "k", ["tied", "id"], ranges=20)
    assert as_set(fast) == as_set(summarize_runs(plain, "k", ["tied", "id"]), *fast.columns)


@pytest.mark.parametrize("kind", ["timestamp", "date", "string", "decimal(12,3)", "float", "boolean"])
def test_order_columns_of_any_orderable_type(spark, kind):
    value = {"timestamp": "timestamp_seconds(i * 37 % 5000)", "date": "date_add(date'2020-01-01', i % 90)",
             "string": "concat('k', i * 7919 % 1000)", "boolean": "i % 2 = 0"}.get(
        kind, f"cast(i * 37 % 900 AS {kind})")
    df = spark.range(700).selectExpr("cast(id AS int) AS i").selectExpr(
        "i", f"CASE WHEN i % 50 = 0 THEN NULL ELSE {value} END AS o", "i % 3 AS u",
        "hash(i) % 2 = 0 AS k")
    for part in ((), "u"):
        plain = tag_runs_window(df, "k", ["o", "i"], part)
        assert as_set(tag_runs(df, "k", ["o", "i"], part, 13)) == as_set(plain)
        fast = consecutive_runs(df, "k", ["o", "i"], part, 13)
        assert as_set(fast) == as_set(summarize_runs(plain, "k", ["o", "i"], part), *fast.columns)


def test_ranges_of_null_nan_and_infinite_values(spark):
    values = [None, float("-inf"), -1.0, 0.0, 2.0, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (1, 3, 7):
        ranged = with_range(df, "r", ["x"], splitters(df, ["x"], n), n)
        got = {repr(r.x): r.r for r in ranged.collect()}
        order = [got[repr(v)] for v in values]
        assert order == sorted(order) and order[-1] == n - 1 and order[0] == 0


def test_random_partitions_and_ranges_equal_the_plain_window(spark):
    rnd = random.Random(13)
    for n in (1, 2, 5, 33):
        rows = [(rnd.choice([None, 1, 2, 3, 4, 4, 4, 4]), rnd.choice(["p", "q", None]), i,
                 rnd.choice([None, "a", "a", "b"])) for i in range(300)]
        df = spark.createDataFrame(rows, "u long, v string, i long, k string")
        for part in ((), "u", ["u", "v"]):
            plain = tag_runs_window(df, "k", "i", part)
            assert as_set(tag_runs(df, "k", "i", part, n)) == as_set(plain)
            fast = consecutive_runs(df, "k", "i", part, n)
            assert as_set(fast) == as_set(summarize_runs(plain, "k", "i", part), *fast.columns)
