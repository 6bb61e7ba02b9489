"""Derived dashboard metrics (J1-J9), computed as DataFrame columns instead of in a browser."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ratio(num, den, scale: float = 1.0) -> F.Column:
    """Guarded division: null when the denominator is 0 or null."""
    return F.when(den > 0, num.cast("double") * F.lit(scale) / den.cast("double"))


def kpi_ratios(kpis: DataFrame) -> DataFrame:
    """J1 (overall), J2, J3 on the KPI row."""
    return kpis.select(
        "*",
        _ratio(F.col("safety_events"), F.col("run_hours")).alias("safety_per_run_hour"),
        _ratio(F.col("impacts"), F.col("safety_events"), 100.0).alias("impacts_pct_of_safety"),
        (F.col("total_machines") - F.col("active_machines")).alias("idle_machines"),
    )


def driver_ratios(top: DataFrame) -> DataFrame:
    """J1 per driver and J6: events per run hour, and share of the largest total (max >= 1)."""
    m = top.agg(F.greatest(F.lit(1), F.coalesce(F.max("total_safety_events"), F.lit(0))).alias("_max"))
    return top.crossJoin(F.broadcast(m)).select(  # one-row aggregate
        *top.columns,
        _ratio(F.col("total_safety_events"), F.col("run_hours")).alias("safety_per_run_hour"),
        (F.col("total_safety_events").cast("double") / F.col("_max")).alias("share_of_max"),
    )


def day_branch_pivot(daily_by_branch: DataFrame, branch_names: list[str]) -> DataFrame:
    """One row per day, one column per branch (0 when absent), and the row total.

    ``branch_names`` comes from the branch dimension (a handful of names), so the
    pivot has a fixed, small set of columns.  Values are summed as whole tenths of
    an hour so the total is exact.
    """
    p = daily_by_branch.groupBy("date", "day").pivot("branch", branch_names).agg(F.sum("tenths"))
    cols = [F.coalesce(F.col(f"`{b}`"), F.lit(0)) for b in branch_names]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return p.select(
        "date",
        "day",
        *[(c / F.lit(10.0)).alias(b) for c, b in zip(cols, branch_names)],
        (total / F.lit(10.0)).alias("total"),
    )


def branch_event_table(safety_by_branch: DataFrame) -> DataFrame:
    """Branch x safety type with the total."""
    return safety_by_branch.select(
        "branch", "impacts", "harsh_braking", "harsh_acceleration", "speeding", "excess_idle",
        F.col("total_safety_events").alias("total"),
    )


def file_totals(files: DataFrame, rows_rejected: DataFrame | None = None) -> DataFrame:
    """Files loaded of all, rows read / loaded, rejected (falls back to read - loaded)."""
    a = files.agg(
        F.count("*").alias("files"),
        F.count_if(F.col("status") != "success").alias("failed_files"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).cast("bigint").alias("rows_read"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("bigint").alias("rows_loaded"),
    )
    a = a.withColumn("files_loaded", F.col("files") - F.col("failed_files"))
    if rows_rejected is None:
        return a.withColumn("rows_rejected", F.col("rows_read") - F.col("rows_loaded"))
    return a.crossJoin(rows_rejected.select(F.col("rows_rejected").alias("_rj"))).select(
        *a.columns, F.coalesce("_rj", F.col("rows_read") - F.col("rows_loaded")).alias("rows_rejected")
    )


def days_without_file(daily_by_branch: DataFrame, files: DataFrame) -> DataFrame:
    """Days present in the data for which no file is registered."""
    days = daily_by_branch.select(F.col("date").alias("d")).distinct()
    have = files.select(F.col("data_day").alias("d")).where(F.col("d").isNotNull())
    return days.join(have, "d", "left_anti").select(F.col("d").alias("date"))


def period_list(daily_by_branch: DataFrame) -> DataFrame:
    """First day, last day and number of days with data."""
    days = daily_by_branch.select("date").distinct()
    return days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("days"))
