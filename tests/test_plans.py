"""Plan shape: where the data is split, and what may sit in one task."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revspark.operators.percentile import lower_percentile
from revspark.operators.runs import consecutive_runs, tag_runs, tag_runs_window
from revspark.plans.queries import QUERIES
from tests.conftest import SF_SMALL, as_set


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    """Exchanges of the plan as it ran, subqueries included: "Exchange hashpartitioning(...", or
    "ReusedExchange ..." for one that was read again."""
    df.collect()
    out, planned = [], None
    for line in physical(df).splitlines():
        depth = len(re.match(r"[\s:+\-]*", line).group())
        if planned is not None and depth >= planned:
            continue  # what was planned before the run
        planned = depth if "== Initial Plan ==" in line else None
        found = re.search(r"[+:]- ((?:Reused)?Exchange .*)", line)
        out += [found.group(1)] if found else []
    return out


def gathered(plan: str) -> list[str]:
    """For each `Exchange SinglePartition`, the first node under it that is no projection: a filter's
    condition, an aggregate, ..."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            names = (re.sub(r"^[\s:+\-*()0-9]*", "", x) for x in lines[i + 1:])
            out.append(next(x for x in names if not x.startswith("Project")))
    return out


BORDERS = ("(__open", "(__end")  # rows at a range's border: two a range at most


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        "user_id", "event_id", "event_type")


@pytest.mark.parametrize("op", [consecutive_runs, tag_runs])
@pytest.mark.parametrize("part", [(), "user_id"])
def test_runs_gather_only_rows_at_borders(spark, op, part):
    plan = physical(op(events(spark), "event_type", "event_id", part))
    nodes = gathered(plan)
    assert nodes and all(n.startswith("Filter") and BORDERS[0] in n for n in nodes)
    assert "SortAggregate" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("by", [(), "user_id"])
def test_percentiles_gather_only_rows_at_borders(spark, by):
    plan = physical(lower_percentile(events(spark), "event_id", 90, by=by))
    nodes = gathered(plan)
    borders = [n for n in nodes if n.startswith("Filter") and BORDERS[1] in n]
    assert borders and "SortAggregate" not in plan and "NestedLoop" not in plan
    # Without groups, each task's least answer is gathered too.
    assert all("HashAggregate" in n for n in nodes if n not in borders)


@pytest.mark.parametrize("name", ["event_runs_by_user", "conversation_role_runs", "event_run_tags",
                                  "event_runs_by_time", "event_runs_global"])
def test_runs_shuffle_their_rows_once(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    by_range = [x for x in exchanges(df) if x.startswith("Exchange hashpartitioning(__range#")]
    again = [x for x in exchanges(df) if x.startswith("ReusedExchange") and "_range" in x]
    assert len(by_range) == 1 and again and "SortAggregate" not in physical(df)


def test_percentiles_derive_their_input_once(spark):
    df = QUERIES["percentile_by_product"](spark, SF_SMALL)
    counted = [x for x in exchanges(df) if "hashpartitioning(productID#" in x]
    # Deriving reviews joins two tables; the counts' shuffle is read by the sample and by the answer.
    assert sum(x.startswith("Exchange") for x in counted) == 1
    assert any(x.startswith("ReusedExchange") for x in counted)


keys = st.lists(st.sampled_from(["a", "b", None]), min_size=0, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=keys, ranges=st.integers(min_value=1, max_value=9), stride=st.integers(1, 4))
def test_runs_property(spark, keys, ranges, stride):
    rows = [(i * stride, i % 3, k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "pos long, part long, k string")
    for part in ((), "part"):
        fast = tag_runs(df, "k", "pos", part, ranges)
        assert as_set(fast) == as_set(tag_runs_window(df, "k", "pos", part))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.integers(-20, 20), min_size=0, max_size=60),
       p=st.sampled_from([0, 10, 33.3, 50, 90, 99.9, 100]),
       ranges=st.integers(1, 20))
def test_percentile_property(spark, values, p, ranges):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = lower_percentile(df, "x", p, ranges=ranges).collect()[0][0]
    s = sorted(float(v) for v in values)
    assert got == (s[int((p / 100.0) * (len(s) - 1))] if s else 0.0)
