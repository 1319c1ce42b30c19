"""Exact lower percentile, as the reference defines it.

For n sorted values the answer is the value at index ``floor(p/100 * (n - 1))`` (0-based); an
empty input gives 0. No built-in matches this: ``percentile`` interpolates,
``percentile_disc`` takes ceil(p*n)-1, ``percentile_approx`` is approximate.

Plan, all on DataFrames, no value lists anywhere; nothing runs while it is built:

1. Count rows per group and distinct value (partial aggregation: duplicates collapse in the map tasks,
   so a value held by a third of all rows is one row a task).
2. The order (group, value) of these counts is cut into ranges inside the plan
   (``operators.splitters``; the sample reads the counts' shuffle, not the source again) and the counts
   are dealt by range: a group of any size goes over as many tasks as its distinct values need.
3. Running counts within a range. A group that lies within one range has its size and its target
   index there. Only the first and the last group of a range can go on in another: two rows a range,
   over which a window carries the counts before and the group's size.
4. The answer is the value whose running count passes the target.

Every step is exact: ranges only decide where work happens. Null values are ignored; NaN sorts
above every number. The answer has the value column's type, which may be any orderable one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.operators.splitters import range_count, splitters, with_range

_V, _C, _RNG, _PREV, _NEXT = "__v", "__c", "__range", "__prev", "__next"
_CUM, _ALL, _BEGIN, _END, _UNTIL = "__cum", "__all", "__begin", "__end", "__until"
_SIZE, _FIRST, _LAST, _SUM = "__size", "__first", "__last", "__sum"
_AHEAD, _WHOLE, _TARGET = "__ahead", "__whole", "__target"
_FIRST_AHEAD, _FIRST_WHOLE, _LAST_WHOLE = "__first_ahead", "__first_whole", "__last_whole"


def _check(p: float) -> float:
    if not 0 <= p <= 100:
        raise ValueError("Percentile must be between 0 and 100")
    return p / 100.0


def _running(spec):
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _grouped_sums(rows: DataFrame, within: list[str], order: list[str], group: Column, amount: str,
                  running: str) -> DataFrame:
    """Rows in the order of ``order`` (``within`` the same values of some columns) with the
    ``running`` sum of ``amount``; that sum before the row's group begins (``_BEGIN``) and where the
    group ends (``_UNTIL``); and whether the row is the group's last (``_END``). Groups are neighbours
    in that order, and no two rows are alike in it."""
    onwards = Window.partitionBy(*within).orderBy(*order)
    # Backwards too: a frame from the row to the end would be gone through anew for each row.
    backwards = Window.partitionBy(*within).orderBy(*[F.desc(c) for c in order])
    rows = rows.withColumns({_PREV: F.lag(group).over(onwards), _NEXT: F.lead(group).over(onwards),
                             running: F.sum(amount).over(_running(onwards))})
    starts = F.col(_PREV).isNull() | ~F.col(_PREV).eqNullSafe(group)
    ends = F.col(_NEXT).isNull() | ~F.col(_NEXT).eqNullSafe(group)
    # The running sum never falls, so the last start's is the greatest, the next end's the least.
    begin = F.max(F.when(starts, F.col(running) - F.col(amount))).over(_running(onwards))
    until = F.min(F.when(F.col(_END), F.col(running))).over(_running(backwards))
    rows = rows.withColumns({_BEGIN: begin, _END: ends})
    return rows.withColumn(_UNTIL, until).drop(_PREV, _NEXT)


def _across_ranges(ends: DataFrame, group: Column) -> DataFrame:
    """One row for each range: what its first group has in earlier ranges, and the sizes of its first
    and its last group. ``ends``: the last row of the first and of the last group of each range."""
    rows = _grouped_sums(ends.drop(_BEGIN, _UNTIL), [], [_RNG, _CUM], group, _SIZE, _SUM)
    rows = rows.withColumns({_AHEAD: F.col(_SUM) - F.col(_SIZE) - F.col(_BEGIN),
                             _WHOLE: F.col(_UNTIL) - F.col(_BEGIN)})
    return rows.groupBy(_RNG).agg(
        F.max(F.when(F.col(_FIRST), F.col(_AHEAD))).alias(_FIRST_AHEAD),
        F.max(F.when(F.col(_FIRST), F.col(_WHOLE))).alias(_FIRST_WHOLE),
        F.max(F.when(F.col(_LAST), F.col(_WHOLE))).alias(_LAST_WHOLE))


def lower_percentile(
    df: DataFrame,
    value: str,
    p: float,
    by: str | Sequence[str] = (),
    alias: str = "percentile",
    ranges: int | None = None,
) -> DataFrame:
    """Exact lower ``p``-th percentile of ``value``, per group of ``by`` or over all rows.

    Grouped: one row per group with at least one non-null value. Global: always one row; without any
    value it is 0 (null, if the column's type is no number). ``ranges``: how many to cut the work into
    (default: a few for each of the session's shuffle partitions).
    """
    frac = _check(p)
    parts = [by] if isinstance(by, str) else list(by)
    values = df.where(F.col(value).isNotNull()).select(*parts, F.col(value).alias(_V))
    counts = values.groupBy(*parts, _V).agg(F.count(F.lit(1)).alias(_C))
    n = range_count(df, ranges)
    order = [*parts, _V]
    # The sample keeps the counts' own columns, or it would shuffle rows of its own.
    cuts = splitters(counts.where(F.col(_C) > 0), order, n)
    rows = with_range(counts, _RNG, order, cuts, n)

    group = F.struct(F.lit(0).alias("none"), *[F.col(c).alias(f"p{i}") for i, c in enumerate(parts)])
    rows = _grouped_sums(rows, [_RNG], order, group, _C, _CUM)
    rows = rows.withColumn(_ALL, F.sum(_C).over(Window.partitionBy(_RNG))).withColumns({
        _SIZE: F.col(_UNTIL) - F.col(_BEGIN), _FIRST: F.col(_BEGIN) == 0,
        _LAST: F.col(_UNTIL) == F.col(_ALL)}).drop(_ALL)
    ends = rows.where(F.col(_END) & (F.col(_FIRST) | F.col(_LAST)))
    found = rows.join(_across_ranges(ends, group), _RNG)
    size = F.when(F.col(_FIRST), F.col(_FIRST_WHOLE)).when(
        F.col(_LAST), F.col(_LAST_WHOLE)).otherwise(F.col(_SIZE))
    ahead = F.when(F.col(_FIRST), F.col(_FIRST_AHEAD)).otherwise(F.lit(0))
    upto = F.col(_CUM) - F.col(_BEGIN) + ahead
    found = found.withColumn(
        _TARGET, F.floor(F.lit(frac) * (size - 1).cast("double")).cast("long")).where(
        (upto > F.col(_TARGET)) & (upto - F.col(_C) <= F.col(_TARGET))).select(
        *parts, F.col(_V).alias(alias))
    if parts:
        return found
    dtype = df.schema[value].dataType
    nothing = F.lit(0 if isinstance(dtype, T.NumericType) else None).cast(dtype)
    return found.agg(F.coalesce(F.min(alias), nothing).alias(alias))
