"""The star schema as a bundle of DataFrames.

Natural keys replace the source system's identity columns, except ``branch_id``,
which is kept because the "operating branch" tie-break picks the lowest one.

  branches       branch_id int, name string
  machines       ref_no string, home_branch_id int, machine_type string
  drivers        driver_key string, first_name string, surname string, display_name string
  event_types    code, label, counts_as_event, is_safety_event
  source_files   file_name, delivery_date, data_date, checksum, first_loaded_at, last_loaded_at, load_count
  ingestion_runs run_id, file_name, started_at, finished_at, status, rows_read, rows_loaded,
                 rows_already_loaded, rows_rejected, error_message, triggered_by
  pipeline_runs  started_at, triggered_by, files_seen, files_to_load, logged_at
  events         ref_no, event_time (timestamp_ntz), event_date, event_type, run_hours_seconds,
                 driver_key, event_branch_id, file_name, source_line, is_late_arrival, branch_mismatch
  rejected_rows  file_name, line_no, raw_line, reason, detail
  interval_days  event_date, ref_no, driver_key, event_branch_id, run_seconds, counter_resets,
                 capped_intervals, intervals (optional; computed from events when absent)
  event_filters  event_date, level, bucket, bits: Bloom filters over the events' natural keys (optional)
  event_days     event_date, event_branch_id, ref_no, driver_key, event_type, events (same)
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmeter.functions.constants import EVENT_TYPES

EVENT_TYPES_SCHEMA = T.StructType(
    [
        T.StructField("raw_label", T.StringType(), False),
        T.StructField("code", T.StringType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("counts_as_event", T.BooleanType(), False),
        T.StructField("is_safety_event", T.BooleanType(), False),
    ]
)


def event_types_df(spark: SparkSession) -> DataFrame:
    """The eight-row event type table (fixed size, safe to broadcast)."""
    return F.broadcast(spark.createDataFrame(EVENT_TYPES, EVENT_TYPES_SCHEMA))


@dataclass
class Tables:
    branches: DataFrame
    machines: DataFrame
    drivers: DataFrame
    event_types: DataFrame
    source_files: DataFrame
    events: DataFrame
    ingestion_runs: DataFrame | None = None
    rejected_rows: DataFrame | None = None
    pipeline_runs: DataFrame | None = None
    interval_days: DataFrame | None = None  # committed interval rollup (operators.intervals.interval_rollup)
    event_days: DataFrame | None = None  # committed event rollup (operators.views.event_rollup)
    event_filters: DataFrame | None = None  # committed key filters (operators.keyfilter.build_filters)
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Tables":
        """A copy with some tables replaced.  New ``events`` drop the stored rollups (they
        describe the old events) unless rollups are passed along explicitly."""
        if "events" in kw:
            kw.setdefault("interval_days", None)
            kw.setdefault("event_days", None)
            kw.setdefault("event_filters", None)
        return replace(self, **kw)

    def committed_events(self) -> DataFrame:
        """Events whose file is registered (the commit point of the load)."""
        return self.events.join(self.source_files.select("file_name"), "file_name", "left_semi")
