"""DuckDB SQL for every registered query, over the same parquet tables (pre-registered views).

Dialect notes: DuckDB arrays are 1-based; its ``length`` counts code points, so the UTF-16
length adds one per character outside the BMP; Unix seconds of a naive timestamp are
``epoch(ts)``; the year of Unix seconds is taken in UTC via ``make_timestamp``; sums of
integers are HUGEINT there, so counts and run numbers are cast to BIGINT.
"""

from __future__ import annotations

from revspark.plans.queries import MEDIAN, PERCENTILE

_RAW = r"""
raw AS (
  SELECT concat('U', CAST(o_custkey AS VARCHAR)) AS reviewerID,
         concat('P', CAST(l_partkey AS VARCHAR)) AS asin,
         CASE WHEN o_custkey % 10 = 0 THEN NULL
              ELSE concat('Name ', CAST(o_custkey AS VARCHAR)) END AS reviewerName,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL
              WHEN l_orderkey % 11 = 0 THEN '1,234'
              WHEN l_orderkey % 13 = 0 THEN 'n/a'
              ELSE CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) END AS vote,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL
              WHEN l_orderkey % 19 = 0 THEN ''
              WHEN l_orderkey % 23 = 0 THEN repeat('good 😀 ', l_linenumber * 6)
              ELSE repeat('review ', l_linenumber * 6) END AS reviewText,
         CASE WHEN l_orderkey % 29 = 0 THEN CAST(0.0 AS DOUBLE)
              WHEN l_orderkey % 31 = 0 THEN CAST(6.0 AS DOUBLE)
              ELSE CAST(1.0 AS DOUBLE)
                   + CAST((l_partkey + l_linenumber) % 9 AS DOUBLE) * CAST(0.5 AS DOUBLE)
         END AS overall,
         l_returnflag AS summary,
         CAST(epoch(l_shipdate) AS BIGINT) AS unixReviewTime,
         strftime(l_shipdate, '%m %d, %Y') AS reviewTime,
         (o_orderstatus = 'F') AS verified,
         [CAST(trunc(l_quantity) AS INTEGER), CAST((l_linenumber % 4) * 20 AS INTEGER)] AS helpful,
         CAST(NULL AS VARCHAR[]) AS image
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_LEN = (
    "CAST(length(reviewText) + length(regexp_replace(reviewText, '[^\\x{10000}-\\x{10FFFF}]', "
    "'', 'g')) AS INTEGER)"
)
_SENTIMENT = (
    "CASE WHEN overall >= 4.0 THEN 'positive' WHEN overall >= 3.0 THEN 'neutral' "
    "ELSE 'negative' END"
)
_YEAR = "CAST(year(make_timestamp(unixReviewTime * 1000000)) AS INTEGER)"
_VOTES = (
    "coalesce(CASE WHEN regexp_matches(vote, '^[+-]?[0-9]+\\z') "
    "THEN try_cast(vote AS INTEGER) END, 0)"
)
_RATIO = (
    "coalesce(CASE WHEN len(helpful) = 2 THEN CASE WHEN helpful[2] > 0 "
    "THEN CAST(helpful[1] AS DOUBLE) / CAST(helpful[2] AS DOUBLE) END END, CAST(0.0 AS DOUBLE))"
)


def _reason(text_missing: str) -> str:
    return f"""CASE WHEN {text_missing}
              WHEN overall IS NULL THEN 'Missing rating'
              WHEN isnan(overall) OR overall < 1.0 OR overall > 5.0 THEN 'Invalid rating value'
              WHEN unixReviewTime IS NULL THEN 'Missing review time' END"""


_REASON_VOTES = _reason("reviewText IS NULL THEN 'Review text is empty or missing'")
_REASON_RATIO = _reason("reviewText IS NULL OR reviewText = '' THEN 'Review text is empty'")


def _valid_votes(source: str = "raw") -> str:
    return f"""
valid AS (
  SELECT reviewerID, asin AS productID, overall AS rating, {_VOTES} AS helpfulnessVotes,
         {_LEN} AS reviewLength, {_SENTIMENT} AS sentiment, {_YEAR} AS year,
         false AS isHighQuality
  FROM {source} WHERE ({_REASON_VOTES}) IS NULL
),
processed AS (SELECT * FROM valid WHERE rating >= 2.0 AND helpfulnessVotes >= 10)"""


_VALID_RATIO = f"""
valid_r AS (
  SELECT reviewerID, asin AS productID, overall AS rating, {_RATIO} AS helpfulnessRatio,
         {_LEN} AS reviewLength, {_SENTIMENT} AS sentiment, {_YEAR} AS year
  FROM raw WHERE ({_REASON_RATIO}) IS NULL
),
processed_r AS (
  SELECT * FROM valid_r WHERE rating >= 2.0 AND helpfulnessRatio >= CAST(0.3 AS DOUBLE)
)"""

_WITH_VOTES = f"WITH {_RAW},{_valid_votes()}\n"
_WITH_RATIO = f"WITH {_RAW},{_VALID_RATIO}\n"

_STATS = """
stats AS (
  SELECT productID, avg(rating) AS avgRating, CAST(count(*) AS BIGINT) AS reviewCount,
         CAST(avg(helpfulnessVotes) AS DOUBLE) AS avgHelpfulness
  FROM processed GROUP BY productID
)"""

_MODE = """
sent_counts AS (SELECT productID, sentiment, count(*) AS c FROM {src} GROUP BY 1, 2),
modes AS (
  SELECT productID, sentiment AS dominantSentiment FROM (
    SELECT productID, sentiment,
           row_number() OVER (PARTITION BY productID ORDER BY c DESC, sentiment ASC) AS rn
    FROM sent_counts) WHERE rn = 1
)"""

_STATS_RATIO = f""",{_MODE.format(src="processed_r")},
stats_r AS (
  SELECT s.productID, s.avgRating, s.reviewCount, s.avgHelpfulness, m.dominantSentiment
  FROM (SELECT productID, avg(rating) AS avgRating, CAST(count(*) AS BIGINT) AS reviewCount,
               avg(helpfulnessRatio) AS avgHelpfulness
        FROM processed_r GROUP BY productID) s
  JOIN modes m ON s.productID IS NOT DISTINCT FROM m.productID
)"""

_PROCESSED_COLS = (
    "p.reviewerID, p.productID, p.rating, p.helpfulnessVotes, p.reviewLength, p.sentiment, "
    "p.year, p.isHighQuality"
)
_PROCESSED_R_COLS = (
    "p.reviewerID, p.productID, p.rating, p.helpfulnessRatio, p.reviewLength, p.sentiment, p.year"
)

_ENRICHED = f""",{_STATS},
enriched AS (
  SELECT {_PROCESSED_COLS}, s.avgRating AS productAvgRating, s.reviewCount AS productReviewCount
  FROM processed p JOIN stats s ON p.productID = s.productID
)"""


def _percentile_sql(source_with: str, source: str, value: str, p: float, by: str | None,
                    alias: str) -> str:
    frac = repr(p / 100.0)
    part = f"PARTITION BY {by} " if by else ""
    ranked = f"""
ordered AS (
  SELECT {by + ', ' if by else ''}{value} AS v,
         row_number() OVER ({part}ORDER BY {value}) - 1 AS idx,
         count(*) OVER ({part.strip()}) AS n
  FROM {source} WHERE {value} IS NOT NULL
)"""
    pick = f"idx = CAST(floor(CAST('{frac}' AS DOUBLE) * CAST(n - 1 AS DOUBLE)) AS BIGINT)"
    if by:
        return (f"{source_with},{ranked}\nSELECT {by}, CAST(v AS DOUBLE) AS {alias} "
                f"FROM ordered WHERE {pick}")
    return (f"{source_with},{ranked}\nSELECT coalesce(max(CASE WHEN {pick} THEN CAST(v AS DOUBLE) "
            f"END), CAST(0.0 AS DOUBLE)) AS {alias} FROM ordered")


def _runs_sql(table: str, key: str, order: str, part: str | None, ties: str = "") -> str:
    """Runs of ``key`` in the order of ``order``, then of the columns named in ``ties``."""
    by = f"{order}{ties}"
    pb = f"PARTITION BY {part} " if part else ""
    cols = f"{part}, " if part else ""
    return f"""
WITH b AS (
  SELECT {cols}{by}, {key},
         CASE WHEN row_number() OVER w > 1 AND lag({key}) OVER w IS NOT DISTINCT FROM {key}
              THEN 0 ELSE 1 END AS brk
  FROM {table} WINDOW w AS ({pb}ORDER BY {by})
),
g AS (
  SELECT *, CAST(sum(brk) OVER ({pb}ORDER BY {by} ROWS BETWEEN UNBOUNDED PRECEDING
                                AND CURRENT ROW) AS BIGINT) AS run_id
  FROM b
)
SELECT {cols}run_id, min({key}) AS {key}, min({order}) AS first_{order},
       max({order}) AS last_{order}, CAST(count(*) AS BIGINT) AS run_len
FROM g GROUP BY {cols}run_id"""


_REVIEW_COLS = (
    "reviewerID, asin, reviewerName, vote, reviewText, overall, summary, unixReviewTime, "
    "reviewTime, image, verified"
)
_RAW_COLS = f"{_REVIEW_COLS}, helpful"

ORACLE: dict[str, str] = {
    "reviews_adapter": f"WITH {_RAW}\nSELECT {_RAW_COLS} FROM raw",
    "valid_reviews": f"{_WITH_VOTES}SELECT * FROM valid",
    "rejected_reviews": (
        f"WITH {_RAW}\nSELECT {_RAW_COLS}, reason FROM "
        f"(SELECT *, {_REASON_VOTES} AS reason FROM raw) WHERE reason IS NOT NULL"
    ),
    "rejects_by_reason": (
        f"WITH {_RAW}\nSELECT reason, CAST(count(*) AS BIGINT) AS n FROM "
        f"(SELECT {_REASON_VOTES} AS reason FROM raw) WHERE reason IS NOT NULL GROUP BY reason"
    ),
    "rejects_by_reason_ratio": (
        f"WITH {_RAW}\nSELECT reason, CAST(count(*) AS BIGINT) AS n FROM "
        f"(SELECT {_REASON_RATIO} AS reason FROM raw) WHERE reason IS NOT NULL GROUP BY reason"
    ),
    "process_reviews": f"{_WITH_VOTES}SELECT * FROM processed",
    "product_stats": f"{_WITH_VOTES},{_STATS}\nSELECT * FROM stats",
    "dominant_sentiment": (
        f"{_WITH_VOTES},{_MODE.format(src='processed')}\nSELECT productID, dominantSentiment "
        f"FROM modes"
    ),
    "enrich_reviews": f"{_WITH_VOTES}{_ENRICHED}\nSELECT * FROM enriched",
    "enrich_self": f"{_WITH_VOTES}{_ENRICHED}\nSELECT * FROM enriched",
    "rank_reviews": (
        f"{_WITH_VOTES}{_ENRICHED}\nSELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY year "
        f"ORDER BY helpfulnessVotes DESC) AS INTEGER) AS helpfulnessRank FROM enriched) "
        f"WHERE helpfulnessRank <= 100"
    ),
    "reviewer_profiles": (
        f"{_WITH_VOTES}SELECT reviewerID, CAST(count(*) AS BIGINT) AS totalReviews, "
        f"avg(rating) AS avgRating, avg(CAST(reviewLength AS DOUBLE)) AS avgReviewLength, "
        f"avg(CAST(helpfulnessVotes AS DOUBLE)) AS helpfulnessScore "
        f"FROM processed GROUP BY reviewerID"
    ),
    "high_quality_count": (
        f"{_WITH_VOTES}SELECT CAST(count(*) AS BIGINT) AS highQualityCount FROM processed "
        f"WHERE rating >= 4.0 AND reviewLength >= 100"
    ),
    "high_quality_count_ratio": (
        f"{_WITH_RATIO}SELECT CAST(count(*) AS BIGINT) AS highQualityCount FROM processed_r "
        f"WHERE rating >= 4.0 AND reviewLength > 100"
    ),
    "percentile_by_product": _percentile_sql(
        _WITH_VOTES.rstrip("\n"), "processed", "rating", PERCENTILE, "productID", "ratingP90"
    ),
    "percentile_global": _percentile_sql(
        _WITH_VOTES.rstrip("\n"), "processed", "rating", PERCENTILE, None, "ratingP90"
    ),
    "median_length_by_year": _percentile_sql(
        _WITH_VOTES.rstrip("\n"), "processed", "reviewLength", MEDIAN, "year", "lengthP50"
    ),
    "event_runs_by_user": _runs_sql("events", "event_type", "event_id", "user_id"),
    "event_runs_global": _runs_sql("events", "event_type", "event_id", None),
    "event_runs_by_time": (
        "SELECT run_id, event_type, strftime(first_ts, '%Y-%m-%d %H:%M:%S.%f') AS first_ts, "
        "strftime(last_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_ts, run_len FROM ("
        + _runs_sql("events", "event_type", "ts", None, ", event_id") + ")"
    ),
    "event_runs_tied_order": _runs_sql(
        "(SELECT event_type, user_id % 3 AS shard, event_id, value >= 50 AS high FROM events)",
        "high", "shard", "event_type", ", event_id"),
    "conversation_role_runs": _runs_sql("conversations", "role", "turn", "conv_id"),
    "process_reviews_by_ratio": f"{_WITH_RATIO}SELECT * FROM processed_r",
    "product_stats_ratio": f"{_WITH_RATIO}{_STATS_RATIO}\nSELECT * FROM stats_r",
    "rank_reviews_ratio": (
        f"{_WITH_RATIO}{_STATS_RATIO}\nSELECT * FROM (SELECT {_PROCESSED_R_COLS}, "
        f"s.avgRating AS productAvgRating, s.reviewCount AS productReviewCount, "
        f"CAST(rank() OVER (PARTITION BY p.year ORDER BY p.helpfulnessRatio DESC) AS INTEGER) "
        f"AS helpfulnessRank FROM processed_r p JOIN stats_r s ON p.productID = s.productID) "
        f"WHERE helpfulnessRank <= 100"
    ),
    "reviewer_profiles_ratio": (
        f"{_WITH_RATIO}SELECT reviewerID, CAST(count(*) AS BIGINT) AS totalReviews, "
        f"avg(rating) AS avgRating, avg(CAST(reviewLength AS DOUBLE)) AS avgReviewLength, "
        f"avg(helpfulnessRatio) AS helpfulnessScore FROM processed_r GROUP BY reviewerID"
    ),
    "filter_min_rating": f"{_WITH_VOTES}SELECT * FROM processed WHERE rating >= 4.0",
    "filter_min_length": f"{_WITH_VOTES}SELECT * FROM processed WHERE reviewLength >= 100",
    "when_then_update": (
        f"{_WITH_VOTES}SELECT reviewerID, productID, "
        f"CASE WHEN reviewLength > 100 THEN rating * 2.0 ELSE rating END AS rating, "
        f"helpfulnessVotes, reviewLength, sentiment, year, "
        f"(rating >= 4.0 AND reviewLength >= 100) AS isHighQuality FROM processed"
    ),
    "transform_pipe": f"{_WITH_VOTES}SELECT * FROM processed",
    "safe_json_parse": (
        "SELECT event_id, CASE WHEN json_valid(props) THEN "
        "try_cast(json_extract(props, '$.k') AS BIGINT) END AS k, "
        "NOT coalesce(json_valid(props), false) AS malformed FROM events"
    ),
    "percentile_event_value": _percentile_sql(
        "WITH event_values AS (SELECT event_type, value FROM events)", "event_values", "value",
        PERCENTILE, "event_type", "valueP90"
    ),
    "event_run_tags": """
WITH b AS (
  SELECT user_id, event_id, event_type,
         CASE WHEN row_number() OVER w > 1 AND lag(event_type) OVER w IS NOT DISTINCT FROM event_type
              THEN 0 ELSE 1 END AS brk
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
)
SELECT user_id, event_id, event_type,
       CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING
                           AND CURRENT ROW) AS BIGINT) AS run_id
FROM b""",
    "sink_roundtrip": f"{_WITH_VOTES},{_STATS}\nSELECT * FROM stats",
    "json_reader": f"WITH {_RAW}\nSELECT {_REVIEW_COLS} FROM raw",
    "json_reader_missing": (
        f"WITH {_RAW}\nSELECT 'there' AS source, CAST(count(*) AS BIGINT) AS n FROM raw "
        f"UNION ALL SELECT 'missing', CAST(0 AS BIGINT)"
    ),
    "json_product_stats": f"{_WITH_VOTES},{_STATS}\nSELECT * FROM stats",
    "json_malformed_lines": (
        "SELECT 'Malformed record' AS reason, CAST(count(*) AS BIGINT) AS n FROM orders"
    ),
    "job_rejected": (
        f"WITH {_RAW}\nSELECT reason, CAST(count(*) AS BIGINT) AS n FROM "
        f"(SELECT {_REASON_VOTES} AS reason FROM raw) WHERE reason IS NOT NULL GROUP BY reason "
        f"UNION ALL SELECT 'Malformed record', CAST(count(*) AS BIGINT) FROM orders"
    ),
}
ORACLE |= {
    "sink_ranked_parquet": ORACLE["rank_reviews"],
    "sink_profiles_json": ORACLE["reviewer_profiles"],
    "job_product_stats": ORACLE["product_stats"],
    "job_ranked_reviews": ORACLE["rank_reviews"],
    "job_reviewer_profiles": ORACLE["reviewer_profiles"],
    "job_ratio_product_stats": ORACLE["product_stats_ratio"],
    "job_ratio_ranked_reviews": ORACLE["rank_reviews_ratio"],
    "job_ratio_reviewer_profiles": ORACLE["reviewer_profiles_ratio"],
    "job_cached_stats": ORACLE["product_stats"],
}
