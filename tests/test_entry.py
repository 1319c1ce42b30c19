import os

import duckdb
import pytest

import __spark_entry__ as entry
from revspark.plans.oracle import ORACLE
from revspark.plans.queries import QUERIES
from revspark.scratch import scratch
from revspark.session import checkpoint_dir
from tests.conftest import SF_SMALL
from tests.test_plans import BORDERS, gathered

# Spark operators that mean Python runs per row or per batch inside a task.
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["productID", "avgRating", "reviewCount", "avgHelpfulness"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) == set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("lineitem", "orders", "events", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM "
                    f"read_parquet('{os.path.join(SF_SMALL, name + '.parquet')}')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        return float(f"{x:.9g}") if isinstance(x, float) else x

    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_and_plan_is_jvm_only(spark, duck, name):
    base = checkpoint_dir(spark).removeprefix("file:")
    left = lambda: (set(os.listdir(base)), {t.name for t in spark.catalog.listTables()})
    before = left()
    with scratch(spark):
        df = entry.queries()[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in PYTHON_NODES), plan
        res = duck.execute(entry.oracle_sql()[name])
        dcols = [d[0] for d in res.description]
        assert sorted(dcols) == sorted(df.columns)
        assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)
    # Whatever the query wrote for itself has gone with its scope.
    assert left() == before


def test_columns_are_pruned_at_the_scans(spark):
    df = entry.queries()["filter_min_rating"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unused in ("l_returnflag", "l_comment", "o_orderstatus"):
        assert not any(unused in line for line in plan.splitlines() if "ReadSchema" in line)


def test_no_query_plans_a_nested_loop_or_gathers_rows(spark):
    for name in ("percentile_global", "event_runs_global", "rank_reviews", "enrich_reviews"):
        df = QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        for node in gathered(plan):
            assert "Aggregate" in node or any(b in node for b in BORDERS)
