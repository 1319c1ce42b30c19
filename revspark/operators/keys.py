"""Grouping keys that may be null, made safe for plain equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def non_null_key(df: DataFrame, name: str, i: int) -> tuple[dict[str, Column], list[str]]:
    """Two non-null columns that together identify a possibly-null key value.

    Plain equality on the pair is null-safe equality on the original, so a join on them stays an
    ordinary equi-join: it keeps null keys (an inner join on the original would drop them) and it
    can reuse a hash partitioning on the same columns instead of shuffling again.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, NUMERIC_TYPES + (T.BooleanType,)):
        value = F.coalesce(col, F.lit(0).cast(dtype))
    elif isinstance(dtype, T.StringType):
        value = F.coalesce(col, F.lit(""))
    else:
        value = F.to_json(F.struct(col.alias("v")))
    v, n = f"__pv{i}", f"__pn{i}"
    return {v: value, n: col.isNull()}, [v, n]


def non_null_keys(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with surrogate columns for every name, and the surrogate names."""
    cols: dict[str, Column] = {}
    keys: list[str] = []
    for i, name in enumerate(names):
        c, k = non_null_key(df, name, i)
        cols.update(c)
        keys += k
    return (df.withColumns(cols) if cols else df), keys
