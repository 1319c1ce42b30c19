import os

import duckdb
import pytest

import corpus_pipeline
from revspark.llm.queries import ORACLE, QUERIES
from revspark.scratch import scratch
from revspark.session import checkpoint_dir
from tests.conftest import SF_SMALL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    return con


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_query_matches_its_sql_and_leaves_nothing_behind(spark, duck, name):
    base = checkpoint_dir(spark).removeprefix("file:")
    left = lambda: (set(os.listdir(base)), {t.name for t in spark.catalog.listTables()})
    before = left()
    with scratch(spark):
        df = (corpus_pipeline.run if name == "pipeline" else QUERIES[name])(spark, SF_SMALL)
        rows = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
        assert rows and left() != before or name in ("op3_token_counts", "op2_toxicity", "op4_quality")
    assert left() == before
    if name in ORACLE:
        found = duck.execute(ORACLE[name])
        names = [d[0] for d in found.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        assert sorted(names) == sorted(df.columns)
        assert rows == sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)
