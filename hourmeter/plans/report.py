"""A cleaning report over every file in a folder (no load).

Per-file summary and failures, unique clean events across files (by natural key),
event totals by type, and the machine-days whose counter reset or whose gaps
were capped.  Unlike E1, the run-hours part counts a machine-day with a single
reading as 0 s (the cross-check method's rule).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.model import event_types_df
from hourmeter.operators.cleaning import Cleaned, clean_records
from hourmeter.operators.intervals import run_intervals
from hourmeter.session import ensure_checkpoint_dir
from hourmeter.sources import files as FS

NATURAL_KEY = ["ref_no", "event_time", "event_type", "run_hours_seconds"]


@dataclass
class CleanReport:
    summary: DataFrame
    failures: DataFrame
    unique_events: DataFrame
    totals_by_type: DataFrame
    flagged_machine_days: DataFrame


def unique_events(rows: DataFrame) -> DataFrame:
    """Clean rows with one row per natural key (the latest file's copy, as the report kept it)."""
    last = rows.groupBy(*NATURAL_KEY).agg(F.max(F.struct("file_name", "source_line")).alias("_w"))
    return rows.join(last, NATURAL_KEY).where(F.struct("file_name", "source_line") == F.col("_w")).drop("_w")


def event_totals_by_type(rows: DataFrame) -> DataFrame:
    """Unique clean events per type."""
    return rows.select(*NATURAL_KEY).distinct().groupBy("event_type").agg(F.count("*").alias("events"))


def machine_day_flags(unique: DataFrame) -> DataFrame:
    """Machine-days (all of them, single readings = 0 s) with their run seconds, resets and caps."""
    ev = unique.select(
        *NATURAL_KEY,
        F.to_date("event_time").alias("event_date"),
        F.col("driver.driver_key").alias("driver_key"),
        F.lit(0).alias("event_branch_id"),
        "file_name",
        "source_line",
    )
    iv = run_intervals(ev).groupBy("event_date", "ref_no").agg(
        F.sum("run_seconds").alias("run_seconds"),
        F.count_if("is_counter_reset").alias("counter_resets"),
        F.count_if("is_capped").alias("capped_intervals"),
    )
    days = ev.select("event_date", "ref_no").distinct()
    z = F.lit(0).cast("bigint")
    return days.join(iv, ["event_date", "ref_no"], "left").select(
        "event_date",
        "ref_no",
        F.coalesce("run_seconds", z).alias("run_seconds"),
        F.coalesce("counter_resets", z).alias("counter_resets"),
        F.coalesce("capped_intervals", z).alias("capped_intervals"),
    )


def report_from_cleaned(c: Cleaned) -> CleanReport:
    u = unique_events(c.rows)
    flags = machine_day_flags(u)
    return CleanReport(
        summary=c.summary,
        failures=c.failures,
        unique_events=u,
        totals_by_type=event_totals_by_type(c.rows),
        flagged_machine_days=flags.where((F.col("counter_resets") > 0) | (F.col("capped_intervals") > 0)),
    )


def clean_report(spark: SparkSession, folder: str, machine_list_path: str, branch_prefix: str = "") -> CleanReport:
    """A19 over every ``*.csv`` in ``folder``.  The parsed records are cut once for all consumers."""
    listing = FS.list_daily_files(spark, folder, pattern=r"(?i)\.csv$")
    paths = [r[0] for r in listing.where("length > 0").select("path").collect()]  # file paths, not rows
    recs = FS.read_daily_csv(spark, paths)
    ml = FS.read_machine_list(spark, machine_list_path, branch_prefix)
    ensure_checkpoint_dir(spark)
    c = clean_records(recs, ml, event_types_df(spark), files=listing.select("file_name"), branch_prefix=branch_prefix, cut=lambda df: df.checkpoint())
    c.classified = c.classified.checkpoint()
    return report_from_cleaned(c)
