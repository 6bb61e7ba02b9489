"""The dashboard: KPIs (E13), hours by day and branch (E14), machine hours (D7, G4),
safety by branch (E9), top drivers (G3), data quality (E11, E15) and the nested
document (I1).

Every section is its own DataFrame.  The run-interval chain (E1) and the event
counts (E3) feed several sections, so ``dashboard_snapshot`` persists them once
per call; ``Snapshot.release()`` frees them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.model import Tables
from hourmeter.operators import filters as FL
from hourmeter.operators import rankings as RK
from hourmeter.operators.intervals import driver_daily_hours, interval_days, machine_daily_hours
from hourmeter.operators.quality import data_quality
from hourmeter.operators.views import event_counts


def resolve_period(t: Tables, date_from=None, date_to=None) -> tuple[str | None, str | None]:
    """Open ends default to the first / last event date (two scalars; literals keep partition pruning)."""
    if date_from is not None and date_to is not None:
        return str(date_from), str(date_to)
    # the stored event rollup has a row for every date with a reading, so its span is the events' span
    src = t.event_days if t.event_days is not None else t.events
    r = src.agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")).first()
    a = date_from if date_from is not None else r["a"]
    b = date_to if date_to is not None else r["b"]
    return (str(a) if a is not None else None, str(b) if b is not None else None)


def kpis(t: Tables, date_from, date_to, daily: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """One row of headline numbers.  Run hours = sum of the per-machine rounded hours,
    re-rounded to one decimal."""
    mh = RK.machine_run_hours(t, date_from, date_to, daily=daily)
    ev = FL.date_range(counts if counts is not None else event_counts(t), "event_date", date_from, date_to)
    a = mh.agg(
        F.coalesce(X.hours_from_hundredths(F.sum("run_hundredths"), 1), F.lit(0.0)).alias("run_hours"),
        F.count_if(F.col("run_hundredths") > 0).alias("active_machines"),
    )
    b = t.machines.agg(F.count("*").alias("total_machines"))
    c = ev.agg(
        F.coalesce(F.sum(F.when(F.col("is_safety_event"), F.col("event_count"))), F.lit(0)).cast("bigint").alias("safety_events"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "IMPACT", F.col("event_count"))), F.lit(0)).cast("bigint").alias("impacts"),
        F.count_distinct("driver_key").alias("active_drivers"),
        F.coalesce(
            F.sum(F.when(F.col("is_safety_event") & F.col("driver_key").isNull(), F.col("event_count"))), F.lit(0)
        ).cast("bigint").alias("events_without_driver"),
    )
    # three one-row aggregates side by side
    return a.crossJoin(b).crossJoin(c).select(
        F.lit(date_from).cast("date").alias("period_from"),
        F.lit(date_to).cast("date").alias("period_to"),
        "run_hours", "active_machines", "total_machines", "safety_events", "impacts", "active_drivers",
        "events_without_driver",
    )


def daily_hours_by_branch(t: Tables, date_from, date_to, daily: DataFrame | None = None) -> DataFrame:
    """Run hours per day and operating branch, one decimal."""
    h = FL.date_range(daily if daily is not None else machine_daily_hours(t), "event_date", date_from, date_to)
    g = h.groupBy("event_date", "day_name", "operating_branch").agg(F.sum("run_seconds").alias("s"))
    return g.select(
        F.col("event_date").alias("date"),
        F.col("day_name").alias("day"),
        F.col("operating_branch").alias("branch"),
        X.hours("s", 1).alias("hours"),
        X.hour_units("s", 1).alias("tenths"),
    ).orderBy("date", "branch")


def machine_hours(t: Tables, date_from, date_to, daily: DataFrame | None = None) -> DataFrame:
    """D7 + G4: every machine with its run hours in the period (0 when idle), highest first."""
    mh = RK.machine_run_hours(t, date_from, date_to, daily=daily).select("ref_no", "run_hours")
    m = t.machines.join(
        t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("branch")), "home_branch_id"
    )
    return (
        m.join(mh, "ref_no", "left")
        .select("ref_no", F.col("machine_type").alias("type"), "branch", F.coalesce("run_hours", F.lit(0.0)).alias("hours"))
        .orderBy(F.desc("hours"), "ref_no")
    )


def quality_section(t: Tables) -> DataFrame:
    """Unfiltered rejected-row total and the time of the last run (one row)."""
    a = t.rejected_rows.agg(F.count("*").alias("rows_rejected"))
    b = t.ingestion_runs.agg(F.max("finished_at").alias("last_run_at"))
    return a.crossJoin(b)


@dataclass
class Snapshot:
    period: tuple
    kpis: DataFrame
    daily_hours_by_branch: DataFrame
    machine_hours: DataFrame
    safety_by_branch: DataFrame
    top_drivers: DataFrame
    files: DataFrame
    quality: DataFrame
    _cached: tuple = ()

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()

    def document(self) -> DataFrame:
        """The whole dashboard as one nested row (``to_json`` it at the edge).

        Arrays are sorted inside Spark; each array has one element per day x branch,
        machine, branch, top driver or registered file."""

        def arr(df: DataFrame, name: str, fields: list[str], order: list):
            return df.agg(
                F.coalesce(
                    F.transform(
                        F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("v")))), lambda x: x["v"]
                    ),
                    F.array(),
                ).alias(name)
            )

        k = self.kpis
        kp = k.select(
            F.struct(F.col("period_from").alias("from"), F.col("period_to").alias("to")).alias("period"),
            F.struct("run_hours", "active_machines", "total_machines", "safety_events", "impacts", "active_drivers").alias("kpis"),
            "events_without_driver",
        )
        d = arr(self.daily_hours_by_branch, "daily_hours_by_branch", ["date", "day", "branch", "hours"],
                [F.col("date").alias("o1"), F.col("branch").alias("o2")])
        m = arr(self.machine_hours, "machine_hours", ["ref_no", "type", "branch", "hours"],
                [(-F.col("hours")).alias("o1"), F.col("ref_no").alias("o2")])
        s = arr(
            self.safety_by_branch.withColumnRenamed("total_safety_events", "total"),
            "safety_by_branch",
            ["branch", "impacts", "harsh_braking", "harsh_acceleration", "speeding", "excess_idle", "total"],
            [F.col("branch").alias("o1")],
        )
        td = arr(
            self.top_drivers,
            "top_drivers",
            ["driver_name", "impacts", "harsh_braking", "harsh_acceleration", "speeding", "excess_idle",
             "total_safety_events", "run_hours"],
            [(-F.col("total_safety_events")).alias("o1"), (-F.col("impacts")).alias("o2"), F.col("driver_name").alias("o3")],
        )
        fl = arr(self.files, "files", ["file_name", "data_day", "status", "rows_read", "rows_loaded", "rows_rejected",
                                       "rejection_reasons", "last_run_at"], [F.col("file_name").alias("o1")])
        doc = kp.crossJoin(d).crossJoin(m).crossJoin(s).crossJoin(td).crossJoin(fl).crossJoin(self.quality)
        return doc.select(
            F.current_timestamp().alias("generated_at"),
            "period",
            "kpis",
            "daily_hours_by_branch",
            "machine_hours",
            "safety_by_branch",
            "top_drivers",
            F.struct(
                "files", "rows_rejected", "last_run_at", "events_without_driver"
            ).alias("data_quality"),
        )

    def write(self, folder: str) -> None:
        """Every section as a table of its own: nothing grows into one row."""
        for name in ("kpis", "daily_hours_by_branch", "machine_hours", "safety_by_branch", "top_drivers", "files", "quality"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")

    def to_json(self) -> str:
        """The document as text, with one element a machine as its readers expect; ``write`` is the way that
        does not gather the machines."""
        return self.document().select(F.to_json(F.struct("*")).alias("j")).first()["j"]


def dashboard_snapshot(t: Tables, date_from=None, date_to=None, cache: bool = True) -> Snapshot:
    """Every dashboard section for a period (default: all data).

    The interval and event rollups (stored by the loads, or computed from the period's
    events; the interval window has the date among its partition keys, so the cut is
    exact and prunes date partitions) feed the hour and count sections; both are cut
    to the period and persisted once per call.
    """
    a, b = resolve_period(t, date_from, date_to)
    def cut(df):
        return None if df is None else FL.date_range(df, "event_date", a, b)

    tp = t.with_(events=cut(t.events), interval_days=cut(t.interval_days), event_days=cut(t.event_days))
    # the warehouse's committed interval rollup when there is one, else the window over the period
    rollup = interval_days(tp)
    counts = FL.date_range(event_counts(tp), "event_date", a, b)  # cut before the persist
    cached = ()
    if cache:
        rollup = rollup.persist(StorageLevel.MEMORY_AND_DISK)
        counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
        cached = (rollup, counts)
    daily = machine_daily_hours(tp, rollup=rollup)
    act = RK.driver_activity(tp, a, b, counts=counts, driver_hours=driver_daily_hours(tp, rollup=rollup))
    return Snapshot(
        period=(a, b),
        kpis=kpis(tp, a, b, daily=daily, counts=counts),
        daily_hours_by_branch=daily_hours_by_branch(tp, a, b, daily=daily),
        machine_hours=machine_hours(tp, a, b, daily=daily),
        safety_by_branch=RK.branch_summary(tp, a, b, daily=daily, counts=counts),
        top_drivers=RK.top_drivers(tp, a, b, activity=act),
        files=data_quality(t),
        quality=quality_section(t),
        _cached=cached,
    )
