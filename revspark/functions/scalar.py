"""Per-row derivations, as Column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: these must equal the reference's for equal results -----------------------
POSITIVE, NEUTRAL, NEGATIVE = "positive", "neutral", "negative"
SENTIMENTS = (NEGATIVE, NEUTRAL, POSITIVE)  # by name
POSITIVE_FROM, NEUTRAL_FROM = 4.0, 3.0  # rating >= 4.0 positive, >= 3.0 neutral, else negative
# A vote string counts only when it is a plain optionally signed decimal integer (what an
# integer parse accepts); `\z` rather than `$`, which would let a trailing newline through.
VOTE_PATTERN = r"^[+-]?[0-9]+\z"
# ----------------------------------------------------------------------------------------------

SECONDS_PER_DAY = 86400


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def helpful_votes(vote="vote") -> Column:
    """Vote string -> int; null, non-numeric, formatted ("1,234", " 12 ") or out-of-range -> 0."""
    v = _c(vote)
    return F.coalesce(F.when(v.rlike(VOTE_PATTERN), v.try_cast("int")), F.lit(0))


def sentiment(rating="rating") -> Column:
    r = _c(rating)
    return (
        F.when(r >= POSITIVE_FROM, F.lit(POSITIVE))
        .when(r >= NEUTRAL_FROM, F.lit(NEUTRAL))
        .otherwise(F.lit(NEGATIVE))
    )


def review_year(epoch_seconds="unixReviewTime") -> Column:
    """Calendar year (UTC) of a Unix time in seconds.

    Goes through the day number, so the answer does not depend on the session time zone.
    """
    days = F.floor(_c(epoch_seconds) / F.lit(SECONDS_PER_DAY)).cast("int")
    return F.year(F.date_from_unix_date(days)).cast("int")


def utf16_length(text="reviewText") -> Column:
    """Length in UTF-16 code units (characters outside the BMP count two), 0 for null."""
    t = _c(text)
    return F.coalesce((F.octet_length(F.encode(t, "UTF-16BE")) / F.lit(2)).cast("int"), F.lit(0))


def helpfulness_ratio(helpful="helpful") -> Column:
    """helpful/total for a two-element [helpful, total] array with total > 0, else 0.0.

    Nested CASE so that no element is read unless the array has exactly two.
    """
    h = _c(helpful)
    pair_ratio = F.when(h[1] > 0, h[0].cast("double") / h[1].cast("double"))
    return F.coalesce(F.when(F.size(h) == 2, pair_ratio), F.lit(0.0))


def epoch_seconds_utc(ts="ts") -> Column:
    """Unix seconds of a TIMESTAMP_NTZ read as UTC wall time, independent of the session zone."""
    t = _c(ts)
    return (
        F.unix_date(F.to_date(t)).cast("long") * F.lit(SECONDS_PER_DAY)
        + F.hour(t).cast("long") * 3600
        + F.minute(t).cast("long") * 60
        + F.second(t).cast("long")
    )
