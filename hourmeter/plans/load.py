"""Idempotent load of cleaned daily files into the folder warehouse.

One run = one distributed clean over every picked file, then one commit:

  1. list the drop folder; files whose length and modification time are registered
     are not read; fingerprint the others and keep those whose (name, checksum) is
     not registered (new, changed, or previously failed)                       A1-A3
  2. read the machine list, upsert machines and their branches                  A5, A8
  3. clean all picked files in one job; files that cannot be read fail alone    B13
  4. insert branches and drivers seen in the clean rows                         A9, A10
  5. append events whose natural key is new (first write wins: earlier file,
     then earlier line), and rejected lines whose (file, line) is new           A11, A12
  6. write the new registry version and commit all small tables at once, or be
     rejected if another run has committed meanwhile; then the run logs         A7, A13-A15

Re-running the same folder inserts nothing.  Every count that the run log
needs is an aggregate, never a driver-side loop over rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.functions.constants import ERROR_MESSAGE_MAX, MACHINE_TYPES
from hourmeter.model import event_types_df
from hourmeter.operators.cleaning import Cleaned, clean_records
from hourmeter.operators.keyfilter import may_be_stored
from hourmeter.plans.store import SCHEMAS, Store, write_rollup
from hourmeter.session import ensure_checkpoint_dir
from hourmeter.sources import files as FS

NATURAL_KEY = ["ref_no", "event_time", "event_type", "run_hours_seconds"]


def pick_files(candidates: DataFrame, registry: DataFrame, reprocess_all: bool = False) -> DataFrame:
    """A3: candidates (file_name, checksum, ...) not registered with the same checksum."""
    if reprocess_all:
        return candidates.orderBy("file_name")
    reg = registry.select("file_name", "checksum")
    return candidates.join(reg, ["file_name", "checksum"], "left_anti").orderBy("file_name")


def insert_branches(branches: DataFrame, names: DataFrame) -> DataFrame:
    """A9 (and the branch half of A8): names not yet present get the next ids, in name order."""
    new = names.where(F.col("name").isNotNull()).distinct().join(branches.select("name"), "name", "left_anti")
    base = branches.agg(F.coalesce(F.max("branch_id"), F.lit(0)).alias("_base"))  # one row
    # ids in name order without one task for all names: ranges of names, the rank inside a range, and the
    # sizes of the ranges before it
    parts = new.repartitionByRange("name").withColumn("_part", F.spark_partition_id()).checkpoint()
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("name"))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))  # one row a range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = parts.withColumn("_at", inside).join(starts, "_part").crossJoin(F.broadcast(base))
    ranked = ranked.select((F.col("_base") + F.col("_start") + F.col("_at")).cast("int").alias("branch_id"), "name")
    return branches.select("branch_id", "name").unionByName(ranked)


def bad_machine_types(machine_list: DataFrame) -> str | None:
    """The A8 type check of every load and replay: an error message if the list has other types."""
    bad = machine_list.where(~F.col("machine_type").isin(MACHINE_TYPES)).select("machine_type").distinct()
    # in order; more than the log's message can hold is never needed
    names = [r[0] for r in bad.orderBy("machine_type").limit(ERROR_MESSAGE_MAX).collect()]
    return f"machine list has machine_type outside {MACHINE_TYPES}: {names}" if names else None


def upsert_machines(machines: DataFrame, branches: DataFrame, machine_list: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Returns (new machines table, changed rows).  Rows whose branch and type are not
    distinct from the stored ones are left alone (updated_at unchanged)."""
    ml = machine_list.join(branches.select(F.col("name").alias("branch"), F.col("branch_id").alias("home_branch_id")), "branch")
    ml = ml.select("ref_no", "home_branch_id", "machine_type")
    old = machines.select(
        "ref_no", F.col("home_branch_id").alias("o_branch"), F.col("machine_type").alias("o_type"), F.col("updated_at").alias("o_at")
    )
    j = ml.join(old, "ref_no", "full_outer")
    in_list = F.col("home_branch_id").isNotNull() | F.col("machine_type").isNotNull()
    changed = in_list & (
        F.col("o_at").isNull()
        | ~F.col("home_branch_id").eqNullSafe(F.col("o_branch"))
        | ~F.col("machine_type").eqNullSafe(F.col("o_type"))
    )
    out = j.select(
        "ref_no",
        F.when(changed, F.col("home_branch_id")).otherwise(F.col("o_branch")).alias("home_branch_id"),
        F.when(changed, F.col("machine_type")).otherwise(F.col("o_type")).alias("machine_type"),
        F.when(changed, F.lit(now)).otherwise(F.col("o_at")).alias("updated_at"),
        changed.alias("_changed"),
    )
    return out.drop("_changed"), out.where("_changed")


def insert_drivers(drivers: DataFrame, rows: DataFrame) -> DataFrame:
    """A10: one row per new driver_key; the first spelling (by file, then line) wins."""
    d = rows.where(F.col("driver").isNotNull()).select(
        "driver.driver_key", "driver.first_name", "driver.surname", "file_name", "source_line"
    )
    # a driver's spellings by file first, which needs no sort: a row each, whatever the readings
    spelt = d.groupBy("driver_key", "first_name", "surname", "file_name", F.col("source_line").isNull().alias("_unnumbered")).agg(
        F.min("source_line").alias("source_line")
    )
    first = spelt.groupBy("driver_key").agg(
        F.min_by(F.struct("first_name", "surname"), F.struct("file_name", "source_line")).alias("s")
    )
    new = first.join(drivers.select("driver_key"), "driver_key", "left_anti").select(
        "driver_key", "s.first_name", "s.surname"
    )
    new = new.withColumn("display_name", F.trim(F.concat_ws(" ", "first_name", "surname")))
    return drivers.select("driver_key", "first_name", "surname", "display_name").unionByName(new)


def new_events(existing: DataFrame, rows: DataFrame, branches: DataFrame, load_id: str, now, filters: DataFrame | None = None) -> DataFrame:
    """Clean rows whose natural key is not stored yet; within the batch the
    earliest (file_name, source_line) copy wins.  The loads' key filters say which rows may be stored
    already; only those are compared with the fact, and only their dates, named to the scan as
    literals, are read from it.  Without filters every date of the batch is."""
    b = few(branches.select(F.col("name").alias("reported_branch"), F.col("branch_id").alias("event_branch_id")))
    r = rows.join(b, "reported_branch").select(
        *NATURAL_KEY,
        F.to_date("event_time").alias("event_date"),
        F.col("driver.driver_key").alias("driver_key"),
        "event_branch_id",
        "file_name",
        "source_line",
        "is_late_arrival",
        "branch_mismatch",
    )
    key = ["event_date", *NATURAL_KEY]
    # the rows meet once; a rank keeps every row at the earliest place, and a key's other copies go before they are dealt
    place = F.rank().over(Window.partitionBy(*key).orderBy("file_name", "source_line"))
    r = r.dropna(subset=key).withColumn("_place", place).where("_place = 1").drop("_place")
    r = r.checkpoint()  # read for its dates, for the filters and for the result
    asked = r.select(*key)
    if filters is not None:
        filters = filters.where(F.col("event_date").isin(_days(asked)))
        asked = may_be_stored(asked, filters, "event_date", key).checkpoint()
    stored = existing.where(F.col("event_date").isin(_days(asked))).select(*key)
    if filters is not None:
        # few may be stored in most loads: then neither the fact nor the new rows are dealt
        stored = few(stored.join(few(asked), key, "left_semi").distinct(), of=asked)
    r = r.join(stored, key, "left_anti")
    return r.withColumn("loaded_at", F.lit(now)).withColumn("load_id", F.lit(load_id))


def few(df: DataFrame, rows: int = 50_000, of: DataFrame | None = None) -> DataFrame:
    """``df``, to be broadcast if it has few rows; they are counted in ``of`` (cheap to read, no fewer rows), else in ``df``.
    The planner knows no sizes of checkpointed tables, and it deals rows by a key of few values, such as the branch, to as many
    tasks; a table of many rows has keys enough to spread by."""
    return F.broadcast(df) if (df if of is None else of).limit(rows + 1).count() <= rows else df


def _days(rows: DataFrame) -> list[dt.date]:
    """The dates of ``rows``, one value a calendar day."""
    return [d[0] for d in rows.select("event_date").distinct().collect()]


def new_rejected(existing: DataFrame, rejected: DataFrame, load_id: str, now) -> DataFrame:
    """Rejected lines whose (file, line) is not stored yet (an earlier load's row stays)."""
    names = rejected.select("file_name").distinct()
    held = existing.select("file_name", "line_no").join(names, "file_name", "left_semi")
    r = rejected.join(held, ["file_name", "line_no"], "left_anti")
    return r.withColumn("rejected_at", F.lit(now)).withColumn("load_id", F.lit(load_id))


def register_files(registry: DataFrame, loaded: DataFrame, load_id: str, now) -> DataFrame:
    """Upsert by file name; a new load adds 1 to load_count, takes the new checksum and
    header, length and modification time, and lists its load id.  Dates and first_loaded_at never change."""
    old = registry.alias("o")
    new = loaded.select(
        "file_name",
        F.col("delivery_date").alias("n_delivery"),
        F.col("data_date").alias("n_data"),
        F.col("checksum").alias("n_checksum"),
        F.col("header").alias("n_header"),
        F.col("length").alias("n_length"),
        F.col("modified").alias("n_modified"),
    )
    j = old.join(new, "file_name", "full_outer")
    hit = F.col("n_checksum").isNotNull() | F.col("n_data").isNotNull() | F.col("n_header").isNotNull()
    return j.select(
        "file_name",
        F.coalesce("delivery_date", "n_delivery").alias("delivery_date"),
        F.coalesce("data_date", "n_data").alias("data_date"),
        F.when(hit, F.col("n_checksum")).otherwise(F.col("checksum")).alias("checksum"),
        F.coalesce("first_loaded_at", F.lit(now)).alias("first_loaded_at"),
        F.when(hit, F.lit(now)).otherwise(F.col("last_loaded_at")).alias("last_loaded_at"),
        F.when(hit, F.coalesce(F.col("load_count"), F.lit(0)) + 1).otherwise(F.col("load_count")).cast("int").alias("load_count"),
        F.when(hit, F.concat(F.coalesce("load_ids", F.array().cast("array<string>")), F.array(F.lit(load_id))))
        .otherwise(F.col("load_ids"))
        .alias("load_ids"),
        F.when(hit, F.col("n_header")).otherwise(F.col("header")).alias("header"),
        F.when(hit, F.col("n_length")).otherwise(F.col("length")).alias("length"),
        F.when(hit, F.col("n_modified")).otherwise(F.col("modified")).alias("modified"),
    )


@dataclass
class RunResult:
    started_at: dt.datetime
    load_id: str
    summary: DataFrame  # A18
    machines_changed: int = 0  # A8: machines that the list added or changed


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_ingest(
    spark: SparkSession,
    store: Store,
    incoming: str,
    machine_list_path: str,
    reprocess_all: bool = False,
    triggered_by: str | None = None,
    started_at: dt.datetime | None = None,
    only: DataFrame | None = None,
) -> RunResult:
    """Pick, clean and load every new or changed daily file in ``incoming`` (or only the file names in
    ``only``, e.g. those of one stream micro-batch).  A file without a byte is a failed file like any other."""
    ensure_checkpoint_dir(spark)
    started = started_at or _now()
    trig = triggered_by or "schedule"
    listing = FS.list_daily_files(spark, incoming)
    if only is not None:
        listing = listing.join(only.select("file_name").distinct(), "file_name", "left_semi")
    seen = listing.count()
    if not seen:
        log_pipeline_run(store, started, trig, 0, 0)
        return RunResult(started, "", run_summary(store, started))
    registry = store.tables().source_files.select("file_name", "checksum", "length", "modified")
    known = listing.join(registry.select("file_name", "length", "modified"), ["file_name", "length", "modified"], "left_semi")
    fresh = listing if reprocess_all else listing.join(known.select("file_name"), "file_name", "left_anti")
    # the paths to read, which the readers need on the driver like any input path
    lines = FS.read_lines(spark, [r["path"] for r in fresh.where("length > 0").select("path").collect()])
    prints = FS.file_fingerprints(lines)
    candidates = fresh.select("file_name", "length", "modified").join(prints, "file_name", "left")
    candidates = candidates.withColumn("checksum", F.coalesce("checksum", F.lit("empty")))
    machine_list = FS.read_machine_list(spark, machine_list_path, store.branch_prefix)
    return load_records(
        spark, store, FS.records_from_lines(lines), candidates, machine_list, reprocess_all=reprocess_all, triggered_by=trig,
        started_at=started, files_seen=seen,
    )


def load_records(
    spark: SparkSession,
    store: Store,
    records: DataFrame | None,
    candidates: DataFrame,
    machine_list: DataFrame,
    reprocess_all: bool = False,
    triggered_by: str | None = None,
    started_at: dt.datetime | None = None,
    files_seen: int | None = None,
) -> RunResult:
    """A16 for a batch: pick (A3) among ``candidates`` (file_name, checksum, and length and modified where
    they come from a listing), clean the picked files' ``records`` and commit them (A7-A14) as one load.
    Raises ``CommitConflict`` if another run commits between reading and committing."""
    ensure_checkpoint_dir(spark)
    started = started_at or _now()
    trig = triggered_by or "schedule"
    load_id = uuid.uuid4().hex
    t = store.tables()
    for c in ("length", "modified"):
        if c not in candidates.columns:
            candidates = candidates.withColumn(c, F.lit(None).cast("bigint"))
    picked = pick_files(candidates, t.source_files, reprocess_all).checkpoint()
    files_to_load = picked.count()
    seen = files_seen if files_seen is not None else candidates.count()
    log_pipeline_run(store, started, trig, seen, files_to_load)  # A15, at run start
    if files_to_load == 0 or records is None:
        return RunResult(started, load_id, run_summary(store, started))

    machine_list = machine_list.checkpoint()
    bad = bad_machine_types(machine_list)

    records = records.join(picked.select("file_name"), "file_name", "left_semi")
    cleaned: Cleaned = clean_records(
        records, machine_list, event_types_df(spark), files=picked.select("file_name"), branch_prefix=store.branch_prefix,
        cut=lambda df: df.checkpoint(),
    )
    cleaned.classified = cleaned.classified.checkpoint()  # cut lineage: one clean, several consumers

    failures = cleaned.failures
    if bad:
        failures = picked.select("file_name", F.lit(bad).alias("error"))
    failures = failures.checkpoint()
    good = picked.select("file_name", "checksum", "length", "modified").join(failures.select("file_name"), "file_name", "left_anti")
    good = (
        good.join(cleaned.headers.select("file_name", "header"), "file_name", "left")
        .withColumn("delivery_date", X.delivery_date_from_name("file_name"))
        .withColumn("data_date", X.data_date_from_name("file_name"))
        .checkpoint()
    )
    n_good = good.count()
    machines_changed = 0

    now = _now()
    runs = []
    if n_good:
        rows = cleaned.rows.join(good.select("file_name"), "file_name", "left_semi")
        rejected = cleaned.rejected.join(good.select("file_name"), "file_name", "left_semi")
        # machines and their branches (A8), then branches and drivers from the rows
        branches = insert_branches(t.branches, machine_list.select(F.col("branch").alias("name"))).checkpoint()
        machines, changed = upsert_machines(t.machines, branches, machine_list, now)
        machines = machines.checkpoint()
        machines_changed = changed.count()
        branches = insert_branches(branches, rows.select(F.col("reported_branch").alias("name"))).checkpoint()
        drivers = insert_drivers(t.drivers, rows).checkpoint()
        ev = new_events(t.events, rows, branches, load_id, now, t.event_filters).checkpoint()
        rj = new_rejected(t.rejected_rows, rejected, load_id, now)
        store.append("events", ev, partition_by=["event_date"])
        write_rollup(store, t.events, ev, load_id, held=t)  # interval rollup of the touched dates, read once committed
        store.append("rejected_rows", rj)
        store.commit(t.extra["manifest"], {
            "branches": store.write_version("branches", branches),
            "machines": store.write_version("machines", machines),
            "drivers": store.write_version("drivers", drivers),
            "source_files": store.write_version("source_files", register_files(t.source_files, good, load_id, now)),
        })
        inserted = ev.groupBy("file_name").agg(F.count("*").alias("rows_loaded"))
        s = cleaned.summary.join(good.select("file_name"), "file_name", "left_semi").join(inserted, "file_name", "left")
        runs.append(
            s.select(
                F.lit(load_id).alias("run_id"),
                "file_name",
                F.lit(started).alias("started_at"),
                F.lit(_now()).alias("finished_at"),
                F.lit("success").alias("status"),
                "rows_read",
                F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"),
                (F.col("rows_clean") - F.coalesce("rows_loaded", F.lit(0))).cast("bigint").alias("rows_already_loaded"),
                "rows_rejected",
                F.lit(None).cast("string").alias("error_message"),
                F.lit(trig).alias("triggered_by"),
            )
        )
    runs.append(failed_runs(failures, load_id, started, _now(), trig))
    log = runs[0] if len(runs) == 1 else runs[0].unionByName(runs[1])
    store.append("ingestion_runs", log)
    return RunResult(started, load_id, run_summary(store, started), machines_changed)


def load_feed(spark: SparkSession, store: Store, readings: DataFrame, batch_name: str, triggered_by: str = "stream") -> None:
    """Load one micro-batch of a reading feed (``streaming.readings.READING``) as a commit of its own, registered under
    ``batch_name``; a batch that is registered already is left alone.  Readings of unknown machines and of unknown types go to the
    quarantine as JSON, so none is lost."""
    ensure_checkpoint_dir(spark)
    t = store.tables()
    if t.source_files.where(F.col("file_name") == batch_name).take(1):
        return
    load_id, started = uuid.uuid4().hex, _now()
    home = t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("home_branch"))
    known = t.machines.join(home, "home_branch_id").select("ref_no", "home_branch")
    types = event_types_df(spark).select(F.col("code").alias("event_type"), F.lit(True).alias("is_type"))
    r = readings.join(known, "ref_no", "left").join(types, "event_type", "left")
    reason = F.when(F.concat_ws("", "ref_no") == "", "missing_required_value").when(F.col("event_time").isNull(), "invalid_timestamp")
    reason = reason.when(F.col("home_branch").isNull(), "machine_not_in_machine_list").when(F.col("is_type").isNull(), "unknown_event_type")
    reason = reason.when(F.coalesce(F.col("run_hours_seconds") < 0, F.lit(True)), "invalid_run_hours")
    name = F.trim(F.concat_ws(" ", "first_name", "surname"))
    driver = F.when(name != "", F.struct("first_name", "surname", F.lower(name).alias("driver_key")))
    r = r.select(
        *NATURAL_KEY,
        F.coalesce("branch", "home_branch").alias("reported_branch"),
        driver.alias("driver"),
        F.lit(batch_name).alias("file_name"),
        F.col("seq").alias("source_line"),
        F.lit(False).alias("is_late_arrival"),
        (~F.coalesce("branch", "home_branch").eqNullSafe(F.col("home_branch"))).alias("branch_mismatch"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in readings.columns]))).alias("raw_line"),
    ).checkpoint()
    n_rows, n_clean = r.agg(F.count(F.lit(1)), F.count_if(F.col("reason").isNull())).first()
    now, loaded, versions = _now(), 0, {}
    if n_clean:
        rows = r.where("reason is null")
        branches = insert_branches(t.branches, rows.select(F.col("reported_branch").alias("name"))).checkpoint()
        drivers = insert_drivers(t.drivers, rows).checkpoint()
        ev = new_events(t.events, rows, branches, load_id, now, t.event_filters).checkpoint()
        store.append("events", ev, partition_by=["event_date"])
        write_rollup(store, t.events, ev, load_id, held=t)
        loaded = ev.count()
        versions = {"branches": store.write_version("branches", branches), "drivers": store.write_version("drivers", drivers)}
    if n_rows > n_clean:
        rejected = r.where("reason is not null").select("file_name", F.col("source_line").alias("line_no"), "raw_line", "reason", F.lit(None).cast("string").alias("detail"))
        store.append("rejected_rows", rejected.withColumn("rejected_at", F.lit(now)).withColumn("load_id", F.lit(load_id)))
    registered = spark.createDataFrame([(batch_name,)], "file_name string").select(
        "file_name", F.lit(None).cast("date").alias("delivery_date"), F.lit(None).cast("date").alias("data_date"), F.lit(load_id).alias("checksum"),
        F.lit(None).cast("array<string>").alias("header"), F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("bigint").alias("modified"),
    )
    versions["source_files"] = store.write_version("source_files", register_files(t.source_files, registered, load_id, now))
    store.commit(t.extra["manifest"], versions)
    log = [(load_id, batch_name, started, _now(), "success", n_rows, loaded, n_clean - loaded, n_rows - n_clean, None, triggered_by)]
    store.append("ingestion_runs", spark.createDataFrame(log, SCHEMAS["ingestion_runs"]))


def failed_runs(failures: DataFrame, run_id: str, started, now, trig: str) -> DataFrame:
    """One 'failed' row per file; the message is cut to 2000 characters and the file
    is not registered, so the next run retries it."""
    return failures.select(
        F.lit(run_id).alias("run_id"),
        "file_name",
        F.lit(started).alias("started_at"),
        F.lit(now).alias("finished_at"),
        F.lit("failed").alias("status"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("rows_read", "rows_loaded", "rows_already_loaded", "rows_rejected")],
        F.substring("error", 1, ERROR_MESSAGE_MAX).alias("error_message"),
        F.lit(trig).alias("triggered_by"),
    )


def log_pipeline_run(store: Store, started, trig: str | None, seen: int, to_load: int) -> None:
    """One row per run (readers keep the last row per started_at)."""
    row = store.spark.createDataFrame(
        [(started, trig or "schedule", int(seen), int(to_load), _now())],
        "started_at timestamp, triggered_by string, files_seen bigint, files_to_load bigint, logged_at timestamp",
    )
    store.append("pipeline_runs", row)


def pipeline_runs(store: Store) -> DataFrame:
    """A15 read side: the last write per started_at wins."""
    p = store.read("pipeline_runs")
    w = Window.partitionBy("started_at").orderBy(F.desc("logged_at"))
    return p.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def run_summary(store: Store, started) -> DataFrame:
    """The log rows of one run, by file name."""
    return store.read("ingestion_runs").where(F.col("started_at") == F.lit(started)).orderBy("file_name")
