"""Reading raw reviews from JSON lines.

``read_reviews`` is the plain reader: a declared schema (no inference pass; absent fields read
as null). ``read_reviews_checked`` keeps every line: lines that do not parse come back in a
second DataFrame with a reason, instead of failing the job or vanishing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.operators.validate import MALFORMED, REASON
from revspark.schemas import CORRUPT_COLUMN, REVIEW, with_corrupt_column

_PARSED = "__parsed"


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_reviews(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW,
    on_missing: str = "raise",
) -> DataFrame:
    """JSON lines at ``path`` with a declared schema.

    ``on_missing="empty"`` turns a missing path into an empty table (the reference's silent
    fallback); the default raises, so a typo cannot overwrite outputs with nothing.
    """
    if on_missing not in ("raise", "empty"):
        raise ValueError("on_missing must be 'raise' or 'empty'")
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as exc:
        if on_missing == "empty" and "PATH_NOT_FOUND" in (exc.getCondition() or str(exc)):
            return _empty(spark, schema)
        raise


def parse_json_lines(lines: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """``lines`` plus a struct of the fields in a JSON string column; its ``_corrupt_record`` holds
    the text of every value that is not a JSON object of that schema (null when it parsed).

    The struct comes out of a generator, which the optimizer doesn't fold into what is above it:
    a line is parsed once, however many fields and filters read it.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = F.from_json(F.col(column), with_corrupt_column(schema), options)
    return lines.select(*lines.columns, F.inline(F.array(F.struct(parsed.alias(_PARSED)))))


def _malformed(struct):
    return struct.isNull() | struct[CORRUPT_COLUMN].isNotNull()


def read_review_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW,
    on_missing: str = "raise",
) -> DataFrame:
    """Every non-blank line at ``path``: ``line``, ``malformed`` and the schema's columns (null
    in malformed lines).

    Reading lines as text and parsing each against the full schema flags a bad line the same way
    whichever columns a later query uses (the JSON reader's corrupt-record column depends on the
    columns it was asked for).
    """
    if on_missing not in ("raise", "empty"):
        raise ValueError("on_missing must be 'raise' or 'empty'")
    try:
        lines = spark.read.text(path)
    except AnalysisException as exc:
        if on_missing != "empty" or "PATH_NOT_FOUND" not in (exc.getCondition() or str(exc)):
            raise
        lines = _empty(spark, T.StructType([T.StructField("value", T.StringType())]))
    lines = lines.where(F.col("value").rlike(r"\S")).select(F.col("value").alias("line"))
    struct = F.col(_PARSED)
    return parse_json_lines(lines, "line", schema).select(
        "line", _malformed(struct).alias("malformed"),
        *[F.when(~_malformed(struct), struct[f.name]).alias(f.name) for f in schema.fields])


def split_lines(lines: DataFrame):
    """(parsed reviews, malformed lines with a reason) of ``read_review_lines``."""
    good = lines.where(~F.col("malformed")).drop("line", "malformed")
    bad = lines.where("malformed").select("line", F.lit(MALFORMED).alias(REASON))
    return good, bad


def read_reviews_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW,
    on_missing: str = "raise",
):
    """(parsed reviews, malformed lines). Blank lines are skipped, as the JSON reader does."""
    return split_lines(read_review_lines(spark, path, schema, on_missing))


def parse_json_column(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """``df`` plus the fields of the JSON object in ``column`` and a ``malformed`` flag."""
    struct = F.col(_PARSED)
    return parse_json_lines(df, column, schema).select(
        *df.columns,
        *[F.when(~_malformed(struct), struct[f.name]).alias(f.name) for f in schema.fields],
        _malformed(struct).alias("malformed"),
    )
