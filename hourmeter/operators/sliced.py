"""Ordered operators over keys that may be hot.

A plain ``Window.partitionBy(key)`` puts a whole key group into one task.  When
one key can hold a large share of all rows (one machine, one user), that task
becomes the job.  These helpers split every key group into ordered *slices*
(e.g. hours of the event time), do the ordered work inside each slice with a
window, and stitch the slices together through a per-slice summary that has
one row per slice.  Results are exact; no group is ever gathered in one task.

Keys must be non-null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "_slice"
_FIRST = "_first_in_slice"


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def sliced_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_col: Column,
    cols: Sequence[str],
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key, by ``order``.

    ``slice_col`` must be monotone in ``order`` within a key (e.g. the hour of the
    ordering timestamp).  ``order`` should be total within a key; rows that tie on
    every order column must agree on ``cols``.
    """
    keys = list(keys)
    df1 = df.withColumn(_SLICE, slice_col)
    w = Window.partitionBy(*keys, _SLICE).orderBy(*_cols(order))
    inner = df1.select(
        "*",
        *[F.lag(c).over(w).alias(prefix + c) for c in cols],
        (F.row_number().over(w) == 1).alias(_FIRST),
    )
    # One row per slice: the last row's values, then the previous slice's last row.
    # Catalyst prunes this branch to the key/order/value columns and aggregates it
    # map-side, so the full rows are shuffled once (for the window) and the summary
    # costs a narrow re-read plus a shuffle of one row per slice and partition.
    last = inner.groupBy(*keys, _SLICE).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*_cols(order))).alias("_last")
    )
    ws = Window.partitionBy(*keys).orderBy(_SLICE)
    prev_last = last.select(*keys, _SLICE, F.lag("_last").over(ws).alias("_prev_last"))
    joined = inner.join(prev_last, on=[*keys, _SLICE], how="left")
    out = joined
    for c in cols:
        out = out.withColumn(
            prefix + c, F.when(F.col(_FIRST), F.col("_prev_last")[c]).otherwise(F.col(prefix + c))
        )
    return out.drop(_SLICE, _FIRST, "_prev_last")


def sliced_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_col: Column,
    value: Column,
    out: str,
) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per key by ``order`` (rows unbounded preceding .. current).

    Inside a slice a window gives the local running sum; a window over the per-slice
    totals (one row per slice) gives each slice's offset.
    """
    keys = list(keys)
    df1 = df.withColumn(_SLICE, slice_col).withColumn("_v", value)
    w = Window.partitionBy(*keys, _SLICE).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = df1.withColumn("_local", F.sum("_v").over(w))
    totals = local.groupBy(*keys, _SLICE).agg(F.sum("_v").alias("_tot"))
    wo = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, _SLICE, F.coalesce(F.sum("_tot").over(wo), F.lit(0)).alias("_off"))
    res = local.join(offsets, on=[*keys, _SLICE], how="left")
    return res.withColumn(out, F.col("_off") + F.col("_local")).drop(_SLICE, "_v", "_local", "_off")


def sliced_running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_col: Column,
    value: Column,
    out: str,
) -> DataFrame:
    """Add ``out`` = running max of ``value`` (nulls ignored) per key by ``order``."""
    keys = list(keys)
    df1 = df.withColumn(_SLICE, slice_col).withColumn("_v", value)
    w = Window.partitionBy(*keys, _SLICE).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = df1.withColumn("_local", F.max("_v").over(w))
    totals = local.groupBy(*keys, _SLICE).agg(F.max("_v").alias("_tot"))
    wo = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, _SLICE, F.max("_tot").over(wo).alias("_off"))
    res = local.join(offsets, on=[*keys, _SLICE], how="left")
    return res.withColumn(out, F.greatest(F.col("_off"), F.col("_local"))).drop(_SLICE, "_v", "_local", "_off")
