import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revspark.schemas import REVIEW  # noqa: E402
from revspark.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="revspark-test-ckpt-")
    s = get_spark(
        "local[*]",
        app_name="revspark-tests",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": ckpt},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="revspark-test-")


def raw_review(**kw):
    """A raw review dict with defaults for every REVIEW field."""
    row = {
        "reviewerID": "U1",
        "asin": "P1",
        "reviewerName": "Noor K.",
        "vote": "12",
        "reviewText": "Hums at night but brews well",
        "overall": 5.0,
        "summary": "Fine kettle",
        "unixReviewTime": 1623750000,
        "reviewTime": "06 15, 2021",
        "image": None,
        "verified": True,
    }
    row.update(kw)
    return row


def raw_df(spark, rows, schema=REVIEW):
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


def as_set(df, *cols):
    cols = cols or tuple(df.columns)
    return {tuple(r[c] for c in cols) for r in df.collect()}
