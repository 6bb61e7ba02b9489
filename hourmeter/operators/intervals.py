"""Run time from a cumulative counter (F1) and its daily roll-ups.

The counter (RunHours, seconds since install) is read at every event.  Time run
between two consecutive readings of the same machine on the same day is the
counter increase, capped at the clock time that passed; a decrease is a counter
reset and adds nothing.  Readings do not carry across midnight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.model import Tables
from hourmeter.operators.sliced import sliced_lag

# Total order of readings inside a machine-day: time, counter, type, then the
# source position (the natural key plus the row's origin; see README).
READING_ORDER = ["event_time", "run_hours_seconds", "event_type", "file_name", "source_line"]


def _slice_of_day(t: str, slice_seconds: int) -> F.Column:
    sod = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.floor(sod / F.lit(slice_seconds)).cast("int")


def run_intervals(events: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """one row per gap between consecutive readings of a machine on one day.

    Columns: ref_no, event_date, event_time, driver_key, event_branch_id,
    counter_increase, clock_seconds, is_counter_reset, is_capped, run_seconds.
    Machine-days are split into ``slice_seconds`` slices so one busy machine
    never lands in one task (see ``operators.sliced``).
    """
    base = events.select(
        "ref_no", "event_date", "event_time", "event_type", "run_hours_seconds",
        "driver_key", "event_branch_id", "file_name", "source_line",
    )
    lagged = sliced_lag(
        base,
        keys=["ref_no", "event_date"],
        order=READING_ORDER,
        slice_col=_slice_of_day("event_time", slice_seconds),
        cols=["run_hours_seconds", "event_time"],
    ).where(F.col("prev_run_hours_seconds").isNotNull())
    inc = F.col("run_hours_seconds") - F.col("prev_run_hours_seconds")
    clock = F.expr("timestampdiff(SECOND, prev_event_time, event_time)")
    return lagged.select(
        "ref_no",
        "event_date",
        "event_time",
        "driver_key",
        "event_branch_id",
        inc.alias("counter_increase"),
        clock.alias("clock_seconds"),
        (inc < 0).alias("is_counter_reset"),
        (inc > clock).alias("is_capped"),
        F.when(inc < 0, F.lit(0).cast("bigint")).otherwise(F.least(inc, clock)).alias("run_seconds"),
    )


# Grain of the interval rollup: everything E1 and E2 need is additive over these keys.
ROLLUP_KEYS = ["event_date", "ref_no", "driver_key", "event_branch_id"]


def interval_rollup(intervals: DataFrame) -> DataFrame:
    """Per (date, machine, driver, event branch): run seconds, resets, capped gaps and interval count.

    Far smaller than the events (a machine-day has a handful of drivers and branches), and
    E1 and E2 are exact roll-ups of it, so a load can store it for the dates it touched
    and questions never re-run the interval window (see ``plans.store``).
    """
    return intervals.groupBy(*ROLLUP_KEYS).agg(
        F.sum("run_seconds").cast("bigint").alias("run_seconds"),
        F.count_if("is_counter_reset").alias("counter_resets"),
        F.count_if("is_capped").alias("capped_intervals"),
        F.count("*").alias("intervals"),
    )


def interval_days(t: Tables, intervals: DataFrame | None = None) -> DataFrame:
    """The rollup: from ``intervals`` if given, else the warehouse's committed copy, else from the events."""
    if intervals is not None:
        return interval_rollup(intervals)
    if t.interval_days is not None:
        return t.interval_days.select(*ROLLUP_KEYS, "run_seconds", "counter_resets", "capped_intervals", "intervals")
    return interval_rollup(run_intervals(t.events))


def machine_daily_hours(t: Tables, intervals: DataFrame | None = None, rollup: DataFrame | None = None) -> DataFrame:
    """Per (event_date, ref_no) run seconds and hours, resets, capped gaps, operating branch.

    The operating branch is the mode of the event branch over the day's intervals;
    a tie goes to the lowest branch id.  A machine-day with a single reading has no
    interval and therefore no row.
    """
    r = rollup if rollup is not None else interval_days(t, intervals)
    per_branch = r.groupBy("event_date", "ref_no", "event_branch_id").agg(
        F.sum("run_seconds").alias("rs"),
        F.sum("counter_resets").alias("cr"),
        F.sum("capped_intervals").alias("ci"),
        F.sum("intervals").alias("n"),
    )
    # mode over intervals = the branch with most intervals; tie -> lowest id; null branches never win
    pick = F.when(F.col("event_branch_id").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("event_branch_id").alias("b")))
    daily = per_branch.groupBy("event_date", "ref_no").agg(
        F.sum("rs").cast("bigint").alias("run_seconds"),
        F.sum("cr").cast("bigint").alias("counter_resets"),
        F.sum("ci").cast("bigint").alias("capped_intervals"),
        F.min_by("event_branch_id", pick).alias("operating_branch_id"),
    )
    m = t.machines.select("ref_no", "machine_type", "home_branch_id")
    hb = t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("home_branch"))
    ob = t.branches.select(F.col("branch_id").alias("operating_branch_id"), F.col("name").alias("operating_branch"))
    return (
        daily.join(m, "ref_no")
        .join(hb, "home_branch_id")
        .join(ob, "operating_branch_id", "left")
        .select(
            "event_date",
            X.day_name("event_date").alias("day_name"),
            "ref_no",
            "machine_type",
            "home_branch",
            "operating_branch",
            "run_seconds",
            X.hours("run_seconds", 2).alias("run_hours"),
            X.hundredths("run_seconds").alias("run_hundredths"),
            "counter_resets",
            "capped_intervals",
        )
    )


def driver_daily_hours(t: Tables, intervals: DataFrame | None = None, rollup: DataFrame | None = None) -> DataFrame:
    """Hours credited to the driver of the later reading of each interval; null driver kept.

    ``run_hundredths`` is the day's rounded hours in hundredths, so later sums of
    rounded daily hours stay exact.
    """
    r = rollup if rollup is not None else interval_days(t, intervals)
    daily = r.groupBy("event_date", "driver_key").agg(F.sum("run_seconds").cast("bigint").alias("run_seconds"))
    d = t.drivers.select("driver_key", "display_name")
    return daily.join(d, "driver_key", "left").select(
        "event_date",
        X.day_name("event_date").alias("day_name"),
        F.coalesce(F.col("display_name"), F.lit(X.NO_DRIVER)).alias("driver_name"),
        "driver_key",
        X.hours("run_seconds", 2).alias("run_hours"),
        X.hundredths("run_seconds").alias("run_hundredths"),
    )
