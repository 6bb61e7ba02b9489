"""Readable events and the counting views.

Dimension joins are plain equi-joins: AQE turns them into broadcast joins at
run time when the measured side is small (a checked broadcast with a
sort-merge fallback).  Only the fixed 8-row event type table is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.functions.constants import NO_DRIVER
from hourmeter.model import Tables


def v_events(t: Tables) -> DataFrame:
    """Every committed event with machine, branches, type flags and driver name."""
    e = t.events
    m = t.machines.select("ref_no", "machine_type", "home_branch_id")
    hb = t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("home_branch"))
    eb = t.branches.select(F.col("branch_id").alias("event_branch_id"), F.col("name").alias("event_branch"))
    et = F.broadcast(
        t.event_types.select(
            F.col("code").alias("event_type"), F.col("label").alias("event_label"), "counts_as_event", "is_safety_event"
        )
    )
    sf = t.source_files.select("file_name")
    d = t.drivers.select("driver_key", "display_name")
    j = (
        e.join(m, "ref_no")
        .join(hb, "home_branch_id")
        .join(eb, "event_branch_id")
        .join(et, "event_type")
        .join(sf, "file_name")
        .join(d, "driver_key", "left")
    )
    return j.select(
        "event_time",
        "event_date",
        X.day_name("event_date").alias("day_name"),
        "ref_no",
        "machine_type",
        "home_branch",
        "event_branch",
        "event_type",
        "event_label",
        "counts_as_event",
        "is_safety_event",
        F.coalesce("display_name", F.lit(NO_DRIVER)).alias("driver_name"),
        "driver_key",
        "run_hours_seconds",
        "is_late_arrival",
        "branch_mismatch",
        F.col("file_name").alias("source_file"),
    )


EVENT_COUNT_KEYS = [
    "event_date", "day_name", "event_branch", "ref_no", "machine_type",
    "driver_name", "driver_key", "event_type", "event_label", "is_safety_event",
]


EVENT_ROLLUP_KEYS = ["event_date", "event_branch_id", "ref_no", "driver_key", "event_type"]


def event_rollup(events: DataFrame) -> DataFrame:
    """Readings per (date, event branch, machine, driver, type): the fact-side grain of E3."""
    return events.groupBy(*EVENT_ROLLUP_KEYS).agg(F.count("*").alias("events"))


def event_days(t: Tables) -> DataFrame:
    """The event rollup: the warehouse's committed copy, else computed from the registered events."""
    if t.event_days is not None:
        return t.event_days.select(*EVENT_ROLLUP_KEYS, "events")
    return event_rollup(t.committed_events())


def event_counts(t: Tables, events_view: DataFrame | None = None) -> DataFrame:
    """Counted events (heartbeat excluded) per day, branch, machine, driver and type.

    Built from the event rollup with the same dimension joins as ``v_events`` (inner to
    machines, home and event branch, type; left to drivers), so a stored rollup answers it
    without scanning the events.
    """
    if events_view is not None:
        v = events_view.where("counts_as_event")
        return v.groupBy(*EVENT_COUNT_KEYS).agg(F.count("*").alias("event_count"))
    et = F.broadcast(
        t.event_types.where("counts_as_event").select(
            F.col("code").alias("event_type"), F.col("label").alias("event_label"), "is_safety_event"
        )
    )  # fixed 8-row table
    m = t.machines.select("ref_no", "machine_type", "home_branch_id")
    hb = t.branches.select(F.col("branch_id").alias("home_branch_id"))
    eb = t.branches.select(F.col("branch_id").alias("event_branch_id"), F.col("name").alias("event_branch"))
    d = t.drivers.select("driver_key", "display_name")
    j = (
        event_days(t)
        .join(et, "event_type")
        .join(m, "ref_no")
        .join(hb, "home_branch_id")
        .join(eb, "event_branch_id")
        .join(d, "driver_key", "left")
        .select(
            "event_date",
            X.day_name("event_date").alias("day_name"),
            "event_branch",
            "ref_no",
            "machine_type",
            F.coalesce("display_name", F.lit(NO_DRIVER)).alias("driver_name"),
            "driver_key",
            "event_type",
            "event_label",
            "is_safety_event",
            "events",
        )
    )
    return j.groupBy(*EVENT_COUNT_KEYS).agg(F.sum("events").cast("bigint").alias("event_count"))


def _all_event_days(t: Tables) -> DataFrame:
    """The event rollup over all events (E4/E5 do not join the dimensions or the registry)."""
    if t.event_days is not None:
        return t.event_days.select(*EVENT_ROLLUP_KEYS, "events")
    return event_rollup(t.events)


def available_days(t: Tables) -> DataFrame:
    """All readings per date (heartbeats included)."""
    return _all_event_days(t).groupBy("event_date").agg(F.sum("events").cast("bigint").alias("events")).select(
        "event_date", X.day_name("event_date").alias("day_name"), "events"
    )


def data_coverage(t: Tables) -> DataFrame:
    """E5: per date, counted events and distinct machines over all readings."""
    et = F.broadcast(t.event_types.select(F.col("code").alias("event_type"), "counts_as_event"))  # 8 rows
    j = _all_event_days(t).join(et, "event_type")
    return (
        j.groupBy("event_date")
        .agg(
            F.coalesce(F.sum(F.when(F.col("counts_as_event"), F.col("events"))), F.lit(0))
            .cast("bigint")
            .alias("events"),
            F.count_distinct("ref_no").alias("active_machines"),
        )
        .select("event_date", X.day_name("event_date").alias("day_name"), "events", "active_machines")
        .orderBy("event_date")
    )


def rejections_by_reason(t: Tables) -> DataFrame:
    """Rejected lines per (file, reason) for registered files."""
    r = t.rejected_rows.join(t.source_files.select("file_name"), "file_name")
    return r.groupBy("file_name", "reason").agg(F.count("*").alias("rows_rejected"))
