"""Per-row semantics against a plain statement of the reference's per-record rules."""

import datetime
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revspark.operators.validate import (
    INVALID_RATING,
    MISSING_RATING,
    MISSING_TIME,
    TEXT_MISSING,
    classify,
    valid_reviews,
)
from tests.conftest import raw_df, raw_review


def java_parse_int(s):
    """Integer.parseInt: optional sign, ASCII digits only, 32-bit range; else 0 (our default)."""
    if s is None or not re.fullmatch(r"[+-]?[0-9]+", s):
        return 0
    v = int(s)
    return v if -(2**31) <= v < 2**31 else 0


def utf16_len(s):
    return len(s.encode("utf-16-be")) // 2


def expected(r):
    text, rating, t = r["reviewText"], r["overall"], r["unixReviewTime"]
    if text is None:
        return TEXT_MISSING, None
    if rating is None:
        return MISSING_RATING, None
    if rating != rating or rating < 1 or rating > 5:
        return INVALID_RATING, None
    if t is None:
        return MISSING_TIME, None
    year = (datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=t)).year
    sentiment = "positive" if rating >= 4 else "neutral" if rating >= 3 else "negative"
    return None, (java_parse_int(r["vote"]), utf16_len(text), sentiment, year)


votes = st.one_of(st.none(), st.sampled_from(["10", "1,234", " 12 ", "12.0", "+5", "-7", "007",
                                               "2147483647", "2147483648", "12\n", "", "abc"]),
                  st.integers(-10**10, 10**10).map(str))
texts = st.one_of(st.none(), st.text(max_size=12))
ratings = st.one_of(st.none(), st.sampled_from([0.0, 0.999, 1.0, 2.5, 3.0, 3.999, 4.0, 5.0,
                                                5.001, float("nan")]))
times = st.one_of(st.none(), st.integers(-2 * 10**9, 4 * 10**9))
review = st.fixed_dictionaries({"vote": votes, "reviewText": texts, "overall": ratings,
                                "unixReviewTime": times})


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(review, min_size=1, max_size=25))
def test_validation_and_derivation(spark, rows):
    full = [raw_review(reviewerID=str(i), **r) for i, r in enumerate(rows)]
    df = raw_df(spark, full)
    reasons = {r.reviewerID: r.reason for r in classify(df).collect()}
    derived = {r.reviewerID: (r.helpfulnessVotes, r.reviewLength, r.sentiment, r.year)
               for r in valid_reviews(df).collect()}
    for i, r in enumerate(full):
        reason, values = expected(r)
        assert reasons[str(i)] == reason, r
        assert derived.get(str(i)) == values, r
