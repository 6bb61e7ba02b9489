"""K6: re-clean quarantined lines after the reference data is fixed.

The registry keeps each file's header, so a rejected line can be cleaned again
exactly as in its file (same column mapping).  Lines that now pass are appended
as events under a new load id (natural-key dedup as in A11) and the load id is
added to those files' registry rows; the quarantine rows stay, as the source
system kept them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.model import event_types_df
from hourmeter.operators.cleaning import clean_records
from hourmeter.plans import load as L
from hourmeter.plans.store import Store, write_rollup
from hourmeter.session import ensure_checkpoint_dir
from hourmeter.sources import files as FS


def replay_rejected(spark: SparkSession, store: Store, machine_list_path: str, reason: str | None = None) -> DataFrame:
    """Returns per file: replayed lines, lines now loaded, lines still rejected."""
    ensure_checkpoint_dir(spark)
    t = store.tables()
    rej = t.rejected_rows if reason is None else t.rejected_rows.where(F.col("reason") == reason)
    rej = rej.select("file_name", "line_no", "raw_line").checkpoint()
    hdr = t.source_files.where(F.col("header").isNotNull()).select(
        "file_name", F.lit(0).cast("bigint").alias("line_no"), F.array_join("header", ",").alias("raw_line"), F.col("header").alias("fields")
    )
    hdr = hdr.join(rej.select("file_name").distinct(), "file_name", "left_semi")
    records = rej.withColumn("fields", FS.parse_fields(F.col("raw_line"))).unionByName(hdr)
    ml = FS.read_machine_list(spark, machine_list_path, store.branch_prefix).checkpoint()
    bad = L.bad_machine_types(ml)
    if bad:
        raise ValueError(bad)
    c = clean_records(records, ml, event_types_df(spark), branch_prefix=store.branch_prefix, cut=lambda df: df.checkpoint())
    c.classified = c.classified.checkpoint()
    load_id = "replay-" + uuid.uuid4().hex
    now = L._now()
    branches = L.insert_branches(t.branches, ml.select(F.col("branch").alias("name")))
    branches = L.insert_branches(branches, c.rows.select(F.col("reported_branch").alias("name"))).checkpoint()
    machines, _ = L.upsert_machines(t.machines, branches, ml, now)
    machines = machines.checkpoint()
    drivers = L.insert_drivers(t.drivers, c.rows).checkpoint()
    ev = L.new_events(t.events, c.rows, branches, load_id, now, t.event_filters).checkpoint()
    touched = ev.select("file_name").distinct().checkpoint()
    if touched.take(1):
        store.append("events", ev, partition_by=["event_date"])
        write_rollup(store, t.events, ev, load_id, held=t)
        reg = t.source_files.join(touched.withColumn("_hit", F.lit(True)), "file_name", "left").withColumn(
            "load_ids",
            F.when(F.col("_hit"), F.concat("load_ids", F.array(F.lit(load_id)))).otherwise(F.col("load_ids")),
        ).drop("_hit")
        store.commit(t.extra["manifest"], {
            "branches": store.write_version("branches", branches),
            "machines": store.write_version("machines", machines),
            "drivers": store.write_version("drivers", drivers),
            "source_files": store.write_version("source_files", reg),
        })
    loaded = ev.groupBy("file_name").agg(F.count("*").alias("rows_loaded"))
    return (
        c.summary.join(loaded, "file_name", "left")
        .select(
            "file_name",
            F.col("rows_read").alias("rows_replayed"),
            F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"),
            F.col("rows_rejected").alias("rows_still_rejected"),
        )
        .orderBy("file_name")
    )
