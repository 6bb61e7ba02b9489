"""M1: the eight named views, registered as temporary views for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

from hourmeter.model import Tables
from hourmeter.operators import intervals as IV
from hourmeter.operators import quality as QL
from hourmeter.operators import views as V

VIEW_NAMES = [
    "v_events",
    "v_run_intervals",
    "v_machine_daily_hours",
    "v_driver_daily_hours",
    "v_event_counts",
    "v_available_days",
    "v_latest_runs",
    "v_rejections_by_reason",
]


def register_views(spark: SparkSession, t: Tables) -> list[str]:
    """Register the views over ``t``; Catalyst plans SQL on them like any DataFrame."""
    views = {
        "v_events": V.v_events(t),
        "v_run_intervals": IV.run_intervals(t.events),
        # from the stored rollups where there are some
        "v_machine_daily_hours": IV.machine_daily_hours(t),
        "v_driver_daily_hours": IV.driver_daily_hours(t),
        "v_event_counts": V.event_counts(t),
        "v_available_days": V.available_days(t),
    }
    if t.ingestion_runs is not None:
        views["v_latest_runs"] = QL.latest_runs(t)
    if t.rejected_rows is not None:
        views["v_rejections_by_reason"] = V.rejections_by_reason(t)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
