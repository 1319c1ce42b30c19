"""Runs of consecutive rows with an equal key (gaps and islands).

The reference walks an in-memory list and starts a new group whenever the key changes. Here the
order is given by columns, and the work is split so that no task holds a whole partition key or
the whole table, at any size:

1. The whole order (partition keys, then order columns, of any orderable types) is cut into ranges
   inside the plan (``operators.splitters``): rows tied in the first order column are split by the
   next one. Rows are shuffled once, by their range.
2. A window over each range flags the rows whose partition key or key differs from the row before and
   numbers the range's local runs; a grouped aggregate over the same partitioning turns rows into local
   runs. A partition key that starts within a range has its final run numbers already.
3. Only the first and the last run of each range can cross a border, whatever the number of partition
   keys in it. They make a table of two rows a range; a window over it carries the run number of the
   partition key that is open at each border from range to range.
4. Inner runs are final. What a run that crosses borders has in all its ranges is summed over that
   table and goes to its first piece; the other pieces are dropped.

A key held by a third of all rows is split over the ranges like any other. Keys compare null-safely
(two null keys are equal, as in the reference's comparison).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revspark.operators.splitters import range_count, splitters, with_range

RUN_ID = "run_id"

_RNG, _BRK, _CUM, _OPEN, _CLOSE = "__range", "__brk", "__cum", "__open", "__close"
_PREV, _AHEAD, _LOCAL, _CARRIED = "__prev", "__ahead", "__local", "__carried"
_SUM, _VALUE, _OFF, _GOES_ON = "__sum", "__value", "__off", "__goes_on"
_CHAIN, _WHOLE = "__chain", "__whole"


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _running(spec):
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _identity(parts: list[str], key: str) -> Column:
    """A row's partition key and key in one value, for null-safe comparison with another row's."""
    part = F.struct(F.lit(0).alias("none"), *[F.col(p).alias(f"p{i}") for i, p in enumerate(parts)])
    return F.struct(part.alias("part"), F.struct(F.col(key).alias("k")).alias("key"))


def _follows(before: Column, own: Column) -> tuple[Column, Column]:
    """Whether a row goes on with the partition key, and with the run, of the row before it."""
    part = before.isNotNull() & before["part"].eqNullSafe(own["part"])
    return part, part & before["key"].eqNullSafe(own["key"])


def _local(df: DataFrame, key: str, orders: list[str], parts: list[str], ranges: int | None
           ) -> DataFrame:
    """Rows with their range, the number of their local run in it (``_CUM``) and within their
    partition key's rows of it (``_LOCAL``), whether that key may have begun in an earlier range
    (``_CARRIED``), and whether the row opens or closes the range."""
    by = [*parts, *orders]
    n = range_count(df, ranges)
    rows = with_range(df, _RNG, by, splitters(df, by, n), n)
    spec = Window.partitionBy(_RNG).orderBy(*by)
    own = _identity(parts, key)
    rows = rows.withColumns({_PREV: F.lag(own).over(spec),
                             _CLOSE: F.lead(F.lit(1)).over(spec).isNull()})
    same_part, same = _follows(F.col(_PREV), own)
    rows = rows.withColumns({_BRK: F.when(same, 0).otherwise(1), _OPEN: F.col(_PREV).isNull(),
                             _AHEAD: ~same_part}).drop(_PREV)
    rows = rows.withColumn(_CUM, F.sum(_BRK).over(_running(spec)))
    ahead = F.max(F.when(F.col(_AHEAD), F.col(_CUM) - 1)).over(_running(spec))
    rows = rows.withColumn(_AHEAD, ahead)
    return rows.withColumns({_LOCAL: F.col(_CUM) - F.col(_AHEAD),
                             _CARRIED: F.col(_AHEAD) == 0}).drop(_BRK, _AHEAD)


def _across(ends: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """``ends``, the first and last local run (or row) of each range, in the order of the ranges: with
    the number of runs that the partition key open at the range's start has before (``_OFF``, at rows
    that open a range), and whether the row goes on with the run of the row before (``_GOES_ON``). Run
    numbers are a sum over the borders that starts anew where a partition key does."""
    across = Window.orderBy(_RNG, _CUM, F.desc(_OPEN))
    same_part, same = _follows(F.lag(_identity(parts, key)).over(across), _identity(parts, key))
    step = F.when(F.col(_OPEN), F.when(same, 0).otherwise(1)).otherwise(
        F.when(F.col(_CARRIED), F.col(_LOCAL) - 1).otherwise(F.col(_LOCAL)))
    anew = F.when(F.col(_OPEN), ~same_part).otherwise(~F.col(_CARRIED))
    found = ends.withColumns({_VALUE: step.cast("long"), _BRK: anew,
                              _GOES_ON: F.col(_OPEN) & same})
    found = found.withColumn(_SUM, F.sum(_VALUE).over(_running(across)))
    before = F.max(F.when(F.col(_BRK), F.col(_SUM) - F.col(_VALUE))).over(_running(across))
    return found.withColumn(_OFF, F.col(_SUM) - before - 1)


def _numbered(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Local runs or rows with their final run number; joined on the column they are dealt by."""
    carried = F.when(F.col(_CARRIED), F.col(_OFF)).otherwise(F.lit(0))
    return rows.join(offsets, _RNG).withColumn(RUN_ID, (F.col(_LOCAL) + carried).cast("long"))


def tag_runs(
    df: DataFrame,
    key: str,
    order: str | Sequence[str],
    partition_by: str | Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Every row plus ``run_id``: the number of its run, from 1, within its partition.

    ``order`` must be a total order within each partition (add tie-breakers); its columns may be of
    any orderable type. ``ranges``: how many to cut the order into (default: a few for each of the
    session's shuffle partitions).
    """
    parts = _as_list(partition_by)
    rows = _local(df, key, _as_list(order), parts, ranges)
    ends = rows.where(F.col(_OPEN) | F.col(_CLOSE)).select(
        _RNG, _CUM, _LOCAL, _CARRIED, _OPEN, *dict.fromkeys([*parts, key]))
    offsets = _across(ends, key, parts).where(_OPEN).select(_RNG, _OFF)
    return _numbered(rows, offsets).select(*df.columns, RUN_ID)


def tag_runs_window(
    df: DataFrame, key: str, order: str | Sequence[str], partition_by: str | Sequence[str] = ()
) -> DataFrame:
    """Plain window form, one task per partition key (the whole table if none): the brute-force
    check of ``tag_runs``, not used by any plan."""
    orders = _as_list(order)
    parts = _as_list(partition_by)
    spec = Window.partitionBy(*parts) if parts else Window.partitionBy()
    spec = spec.orderBy(*[F.col(c) for c in orders])
    prev = F.lag(F.struct(F.col(key).alias("k"))).over(spec)
    same = prev.isNotNull() & prev["k"].eqNullSafe(F.col(key))
    return (
        df.withColumn(_BRK, F.when(same, F.lit(0)).otherwise(F.lit(1)))
        .withColumn(RUN_ID, F.sum(_BRK).over(_running(spec)).cast("long"))
        .drop(_BRK)
    )


def summarize_runs(
    tagged: DataFrame, key: str, order: str | Sequence[str], partition_by: str | Sequence[str] = ()
) -> DataFrame:
    """One row per run of tagged rows: partition keys, run_id, key, first and last order value,
    length; partial aggregation makes a run of any length one row per task."""
    o = _as_list(order)[0]
    parts = _as_list(partition_by)
    return tagged.groupBy(*parts, RUN_ID, key).agg(
        F.min(o).alias(f"first_{o}"),
        F.max(o).alias(f"last_{o}"),
        F.count(F.lit(1)).alias("run_len"),
    )


def consecutive_runs(
    df: DataFrame,
    key: str,
    order: str | Sequence[str],
    partition_by: str | Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """One row per run: partition keys, run_id, key, first and last order value, run_len.

    Rows become local runs before anything is joined; only runs at a range's border are put together.
    """
    orders, parts = _as_list(order), _as_list(partition_by)
    o = orders[0]
    first, last = f"first_{o}", f"last_{o}"
    rows = _local(df, key, orders, parts, ranges)
    by = dict.fromkeys([_RNG, _CUM, _LOCAL, _CARRIED, *parts, key])
    local = rows.groupBy(*by).agg(
        F.min(o).alias(first), F.max(o).alias(last), F.count(F.lit(1)).alias("run_len"),
        F.max(_OPEN).alias(_OPEN), F.max(_CLOSE).alias(_CLOSE))
    ends = _across(local.where(F.col(_OPEN) | F.col(_CLOSE)), key, parts)
    # A chain: the pieces of one run, from the range it begins in to the one it ends in.
    ends = ends.withColumn(_CHAIN, F.sum(F.when(F.col(_GOES_ON), 0).otherwise(1)).over(
        _running(Window.orderBy(_RNG, _CUM))))
    chain = Window.partitionBy(_CHAIN)
    whole = F.struct(F.min(first).over(chain).alias("first"), F.max(last).over(chain).alias("last"),
                     F.sum("run_len").over(chain).alias("n"))
    ends = ends.withColumn(_WHOLE, whole)
    # One row a range, that of its first run; with the totals of its last, the same or the next one.
    last_whole = F.lead(_WHOLE).over(Window.partitionBy(_RNG).orderBy(_CUM))
    borders = ends.withColumn(_WHOLE, F.when(F.col(_CLOSE), F.col(_WHOLE)).otherwise(last_whole))
    borders = borders.where(_OPEN).select(_RNG, _OFF, _GOES_ON, _WHOLE)
    runs = _numbered(local, borders).where(~(F.col(_OPEN) & F.col(_GOES_ON)))
    of = lambda field, own: F.when(
        F.col(_CLOSE), F.col(_WHOLE)[field]).otherwise(F.col(own)).alias(own)
    return runs.select(*parts, RUN_ID, key, of("first", first), of("last", last), of("n", "run_len"))
