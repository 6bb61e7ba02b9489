"""Parameterised questions (E7-E10) and their rankings.

Every filter is optional; ``None`` or blank means no filter.  Every result has a
total order (the metric, then a name) so ``limit`` is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.model import Tables
from hourmeter.operators import filters as FL
from hourmeter.operators.intervals import machine_daily_hours


def machine_run_hours(
    t: Tables,
    date_from=None,
    date_to=None,
    machine_type: str | None = None,
    branch: str | None = None,
    ref_no: str | None = None,
    daily: DataFrame | None = None,
) -> DataFrame:
    """Run hours per machine over a period, highest first."""
    h = daily if daily is not None else machine_daily_hours(t)
    h = FL.date_range(h, "event_date", date_from, date_to)
    h = FL.machine_type_is(h, "machine_type", machine_type)
    h = FL.text_equals_ci(h, "home_branch", branch)
    h = FL.ref_is(h, "ref_no", ref_no)
    out = h.groupBy("ref_no", "machine_type", "home_branch").agg(
        F.sum("run_seconds").alias("run_seconds"),
        F.count_if(F.col("run_seconds") > 0).alias("days_with_activity"),
    )
    return out.select(
        "ref_no",
        "machine_type",
        "home_branch",
        X.hours("run_seconds", 2).alias("run_hours"),
        X.hundredths("run_seconds").alias("run_hundredths"),
        "days_with_activity",
    ).orderBy(F.desc("run_hours"), "ref_no")


from hourmeter.functions.constants import NO_DRIVER, SAFETY_COLUMNS  # noqa: E402
from hourmeter.operators.intervals import driver_daily_hours  # noqa: E402
from hourmeter.operators.views import event_counts  # noqa: E402


def safety_sums(prefix_zero: bool = True) -> list:
    """Pivoted safety counts: one sum per safety type plus the total (nulls -> 0)."""
    aggs = []
    for code, name in SAFETY_COLUMNS:
        s = F.sum(F.when(F.col("event_type") == code, F.col("event_count")))
        aggs.append((F.coalesce(s, F.lit(0)) if prefix_zero else s).cast("bigint").alias(name))
    tot = F.sum(F.when(F.col("is_safety_event"), F.col("event_count")))
    aggs.append((F.coalesce(tot, F.lit(0)) if prefix_zero else tot).cast("bigint").alias("total_safety_events"))
    return aggs


def metric_for(event_type: str | None) -> str:
    """G1: the column a ranking sorts by; unknown or non-safety types rank by the total."""
    code = X.norm_event_type_param(event_type)
    return dict(SAFETY_COLUMNS).get(code, "total_safety_events")


SAFETY_NAMES = [name for _, name in SAFETY_COLUMNS] + ["total_safety_events"]


def driver_activity(
    t: Tables,
    date_from=None,
    date_to=None,
    event_type: str | None = None,
    branch: str | None = None,
    driver_name: str | None = None,
    counts: DataFrame | None = None,
    driver_hours: DataFrame | None = None,
) -> DataFrame:
    """Safety events and run hours per driver, ranked by the requested type (G1).

    Hours are the sum of the already-rounded daily hours; the branch filter applies
    to events only; only drivers with a counted event appear; the missing driver
    is matched null-safely (D2).
    """
    c = counts if counts is not None else event_counts(t)
    c = FL.text_equals_ci(FL.date_range(c, "event_date", date_from, date_to), "event_branch", branch)
    ev = c.groupBy("driver_name", "driver_key").agg(*safety_sums())
    h = driver_hours if driver_hours is not None else driver_daily_hours(t)
    h = FL.date_range(h, "event_date", date_from, date_to)
    hrs = h.groupBy(F.col("driver_key").alias("h_key")).agg(F.sum("run_hundredths").alias("h"))
    j = ev.join(hrs, ev.driver_key.eqNullSafe(hrs.h_key), "left")
    if not X.blank(driver_name):
        j = j.where(F.col("driver_name").ilike("%" + driver_name.strip() + "%"))
    metric = metric_for(event_type)
    return j.select(
        "driver_name",
        *SAFETY_NAMES,
        (F.coalesce(F.col("h"), F.lit(0)) / F.lit(100.0)).cast("double").alias("run_hours"),
        "driver_key",
    ).orderBy(F.desc(metric), "driver_name", "driver_key")


def branch_summary(
    t: Tables, date_from=None, date_to=None, daily: DataFrame | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Per branch, run hours and active machines (by operating branch) and safety events
    (by event branch); every branch appears."""
    h = daily if daily is not None else machine_daily_hours(t)
    h = FL.date_range(h, "event_date", date_from, date_to)
    hrs = h.groupBy(F.col("operating_branch").alias("branch")).agg(
        F.sum("run_seconds").alias("run_seconds"),
        F.count_distinct(F.when(F.col("run_seconds") > 0, F.col("ref_no"))).alias("active_machines"),
    )
    c = counts if counts is not None else event_counts(t)
    c = FL.date_range(c, "event_date", date_from, date_to)
    ev = c.groupBy(F.col("event_branch").alias("branch")).agg(*safety_sums(prefix_zero=False))
    b = t.branches.select(F.col("name").alias("branch"))
    j = b.join(hrs, "branch", "left").join(ev, "branch", "left")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "branch",
        F.coalesce(X.hours("run_seconds", 2), F.lit(0.0)).alias("run_hours"),
        F.coalesce("active_machines", zero).alias("active_machines"),
        *[F.coalesce(n, zero).alias(n) for n in SAFETY_NAMES],
    ).orderBy("branch")


def machine_events(
    t: Tables,
    date_from=None,
    date_to=None,
    event_type: str | None = None,
    machine_type: str | None = None,
    branch: str | None = None,
    ref_no: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Safety events per machine; machines without events are listed with zeros (D3)."""
    m = t.machines.join(
        t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("home_branch")), "home_branch_id"
    ).select("ref_no", "machine_type", "home_branch")
    m = FL.ref_is(FL.text_equals_ci(FL.machine_type_is(m, "machine_type", machine_type), "home_branch", branch), "ref_no", ref_no)
    c = counts if counts is not None else event_counts(t)
    c = FL.date_range(c, "event_date", date_from, date_to)  # the range sits in the join's ON clause
    per = c.groupBy("ref_no").agg(*safety_sums(prefix_zero=False))
    zero = F.lit(0).cast("bigint")
    out = m.join(per, "ref_no", "left").select(
        "ref_no", "machine_type", "home_branch", *[F.coalesce(n, zero).alias(n) for n in SAFETY_NAMES]
    )
    return out.orderBy(F.desc(metric_for(event_type)), "ref_no")


def top_drivers(t: Tables, date_from=None, date_to=None, n: int = 8, activity: DataFrame | None = None) -> DataFrame:
    """The ``n`` drivers with most safety events (missing driver excluded), shown by
    (total desc, impacts desc)."""
    a = activity if activity is not None else driver_activity(t, date_from, date_to)
    top = a.where(F.col("driver_name") != NO_DRIVER).orderBy(
        F.desc("total_safety_events"), "driver_name", "driver_key"
    ).limit(n)
    return top.orderBy(F.desc("total_safety_events"), F.desc("impacts"), "driver_name", "driver_key")
