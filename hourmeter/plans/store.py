"""A folder-backed warehouse for the star schema (no server, no table format).

Layout under ``root``:

  events/event_date=YYYY-MM-DD/...   append-only fact, one ``load_id`` per run
  rejected_rows/                     append-only quarantine, ``load_id`` per run
  interval_days/event_date=.../rollup_load_id=.../   interval rollup of a touched date, one folder a load
  event_days/event_date=.../rollup_load_id=.../      event-count rollup, likewise
  event_filters/event_date=.../      Bloom filters over the natural keys that a load added to a date
  ingestion_runs/ pipeline_runs/     append-only logs
  branches/v=<id>/ machines/v=<id>/ drivers/v=<id>/ source_files/v=<id>/
                                     small tables, rewritten whole by each load
  _manifest/<N>                      commit N: which version of each small table is current

Commit protocol: a run reads manifest N, appends its fact and quarantine rows
under a fresh ``load_id``, writes new versions of the small tables under names
of its own, and last creates manifest N+1, which names a version of every small
table.  That fails if another run has committed N+1 meanwhile: the later run
is rejected (``CommitConflict``) and nothing of it is ever visible, since every
reader takes all small tables through one manifest and keeps only facts whose
(file_name, load_id) the manifest's ``source_files`` lists.  A manifest is
written under another name and renamed without overwriting, which is exclusive
where the file system's rename is (HDFS; an object store needs a file system
layer with such a rename).

Interval rollup: a load writes ``operators.intervals.interval_rollup`` for
every date it adds events to, under its ``load_id`` before the commit.  Readings
never carry across midnight or between machines, so only the machine-days that got
a reading are computed anew; the date's others are copied from its last rollup.  Readers take,
per date, the newest rollup whose load is committed: a load that died leaves a
rollup nobody reads, and a later committed load touching the date supersedes it.
``compact_rollups`` deletes superseded ones.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmeter.model import Tables, event_types_df

SCHEMAS = {
    "branches": "branch_id int, name string",
    "machines": "ref_no string, home_branch_id int, machine_type string, updated_at timestamp",
    "drivers": "driver_key string, first_name string, surname string, display_name string",
    "source_files": (
        "file_name string, delivery_date date, data_date date, checksum string, first_loaded_at timestamp, "
        "last_loaded_at timestamp, load_count int, load_ids array<string>, header array<string>, "
        "length bigint, modified bigint"
    ),
    "events": (
        "ref_no string, event_time timestamp_ntz, event_date date, event_type string, run_hours_seconds bigint, "
        "driver_key string, event_branch_id int, file_name string, source_line bigint, is_late_arrival boolean, "
        "branch_mismatch boolean, loaded_at timestamp, load_id string"
    ),
    "interval_days": (
        "event_date date, ref_no string, driver_key string, event_branch_id int, run_seconds bigint, "
        "counter_resets bigint, capped_intervals bigint, intervals bigint, rollup_load_id string, rolled_at timestamp"
    ),
    "event_days": (
        "event_date date, event_branch_id int, ref_no string, driver_key string, event_type string, events bigint, "
        "rollup_load_id string, rolled_at timestamp"
    ),
    "event_filters": "event_date date, level int, bucket int, bits binary, filter_load_id string",
    "rejected_rows": "file_name string, line_no bigint, raw_line string, reason string, detail string, rejected_at timestamp, load_id string",
    "ingestion_runs": (
        "run_id string, file_name string, started_at timestamp, finished_at timestamp, status string, rows_read bigint, "
        "rows_loaded bigint, rows_already_loaded bigint, rows_rejected bigint, error_message string, triggered_by string"
    ),
    "pipeline_runs": "started_at timestamp, triggered_by string, files_seen bigint, files_to_load bigint, logged_at timestamp",
}
VERSIONED = ["branches", "machines", "drivers", "source_files"]


class CommitConflict(RuntimeError):
    """Another run committed first; nothing of this one is visible."""


class Store:
    """``branch_prefix``: the company name that files put before branch names (C3), if any."""

    def __init__(self, spark: SparkSession, root: str, branch_prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.branch_prefix = branch_prefix

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ------------------------------------------------------------ versions of small tables
    def _jvm_fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def manifest(self) -> tuple[int, dict[str, str]]:
        """The last commit: its number (0: none yet) and the current version of each small table."""
        fs, p = self._jvm_fs(self.path("_manifest"))
        if not fs.exists(p):
            return 0, {}
        n = max((int(st.getPath().getName()) for st in fs.listStatus(p) if st.getPath().getName().isdigit()), default=0)
        if not n:
            return 0, {}
        rows = self.spark.read.text(f"{self.path('_manifest')}/{n}", wholetext=True).first()
        return n, json.loads(rows[0])

    def commit(self, base: int, versions: dict[str, str]) -> int:
        """Make ``versions`` current if nothing was committed since manifest ``base`` was read."""
        now, held = self.manifest()
        if now != base:
            raise CommitConflict(f"commit {base + 1} is taken: read {base}, now {now}")
        # written whole under another name, then renamed: a commit appears complete or not at all
        fs, draft = self._jvm_fs(f"{self.path('_manifest')}/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({**held, **versions}, sort_keys=True).encode()))
        out.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        hadoop = jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        target = hadoop.Path(f"{self.path('_manifest')}/{base + 1}")
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), gateway.new_array(hadoop.Options.Rename, 0))
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if fs.exists(target):
                raise CommitConflict(f"commit {base + 1} is taken") from e
            raise
        return base + 1

    def read(self, table: str, versions: dict[str, str] | None = None) -> DataFrame:
        """A table; a small one as of ``versions`` (default: the last commit)."""
        schema = SCHEMAS[table]
        if table in VERSIONED:
            v = (self.manifest()[1] if versions is None else versions).get(table)
            if v is None:
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).parquet(f"{self.path(table)}/v={v}")
        fs, p = self._jvm_fs(self.path(table))
        if not fs.exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def write_version(self, table: str, df: DataFrame) -> str:
        """Write a version of a small table; it is current once a commit names it."""
        v = uuid.uuid4().hex
        cols = [f.name for f in T._parse_datatype_string(SCHEMAS[table]).fields]
        df.select(*cols).write.mode("error").parquet(f"{self.path(table)}/v={v}")
        return v

    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        cols = [f.name for f in T._parse_datatype_string(SCHEMAS[table]).fields]
        df = df.select(*cols)
        if partition_by:
            # a folder's rows meet first (a large one's in several tasks), or every task would write a file into every folder
            df.hint("rebalance", partition_by[0]).write.mode("append").partitionBy(*partition_by).parquet(self.path(table))
        else:
            df.write.mode("append").parquet(self.path(table))

    # ------------------------------------------------------------ committed view
    def tables(self) -> Tables:
        number, versions = self.manifest()
        sf = self.read("source_files", versions)
        committed = sf.select("file_name", F.explode("load_ids").alias("load_id"))
        events = self.read("events").join(committed, ["file_name", "load_id"], "left_semi")
        rejected = self.read("rejected_rows").join(committed, ["file_name", "load_id"], "left_semi")
        return Tables(
            interval_days=self._committed_rollup(committed, "interval_days"),
            event_days=self._committed_rollup(committed, "event_days"),
            event_filters=self._committed_filters(committed),
            branches=self.read("branches", versions),
            machines=self.read("machines", versions),
            drivers=self.read("drivers", versions),
            event_types=event_types_df(self.spark),
            source_files=sf,
            events=events,
            ingestion_runs=self.read("ingestion_runs"),
            rejected_rows=rejected,
            pipeline_runs=self.read("pipeline_runs"),
            extra={"manifest": number},
        )

    def _committed_filters(self, committed: DataFrame) -> DataFrame | None:
        """The key filters of all committed loads; None in a warehouse whose events were loaded before there were any."""
        fs, p = self._jvm_fs(self.path("event_filters"))
        if not fs.exists(p):
            return None
        ids = committed.select(F.col("load_id").alias("filter_load_id")).distinct()
        return self.read("event_filters").join(ids, "filter_load_id", "left_semi")

    def _committed_rollup(self, committed: DataFrame, table: str) -> DataFrame | None:
        fs, p = self._jvm_fs(self.path(table))
        if not fs.exists(p):
            return None
        ids = committed.select(F.col("load_id").alias("rollup_load_id")).distinct()
        rd = self.read(table).join(ids, "rollup_load_id", "left_semi")
        # newest committed rollup per date; event_date is the grouping key, so a date filter
        # above this reaches both scans as a partition filter
        latest = rd.groupBy("event_date").agg(
            F.max(F.struct("rolled_at", "rollup_load_id"))["rollup_load_id"].alias("rollup_load_id")
        )
        return rd.join(latest, ["event_date", "rollup_load_id"], "left_semi")


def write_rollup(store: Store, committed_events: DataFrame, new_events: DataFrame, load_id: str, held: Tables | None = None) -> None:
    """Append the interval and event rollups of every date ``new_events`` touches, and the key filters of
    ``new_events`` itself, under ``load_id`` (before the commit).

    With the committed rollups in ``held``, late readings are spliced in: intervals are computed anew for the
    machine-days that got a reading, from those machines' events only, and all other machine-days of the date carry
    their rows over; event counts are the held ones plus the new readings', without reading events.  Without, the dates'
    events are rolled up whole."""
    from hourmeter.operators.intervals import ROLLUP_KEYS, interval_rollup, run_intervals
    from hourmeter.operators.keyfilter import build_filters
    from hourmeter.operators.views import EVENT_ROLLUP_KEYS, event_rollup

    # a warehouse has filters from its first commit on or not at all: they must cover every stored event
    fs, p = store._jvm_fs(store.path("event_filters"))
    if fs.exists(p) or not store.manifest()[0]:
        filters = build_filters(new_events, "event_date", ["event_date", "ref_no", "event_time", "event_type", "run_hours_seconds"])
        store.append("event_filters", filters.withColumn("filter_load_id", F.lit(load_id)), partition_by=["event_date"])

    # the touched dates are the partitions to rewrite: one value per calendar day, named to
    # the scan as literals so it prunes to them statically
    days = [r[0] for r in new_events.select("event_date").distinct().collect()]
    if not days:
        return
    cols = ["ref_no", "event_date", "event_time", "event_type", "run_hours_seconds", "driver_key",
            "event_branch_id", "file_name", "source_line"]
    stored = committed_events.where(F.col("event_date").isin(days)).select(*cols)
    if held is not None and held.interval_days is not None and held.event_days is not None:
        touched = new_events.select("event_date", "ref_no").distinct()
        spliced = stored.join(touched, ["event_date", "ref_no"], "left_semi").unionByName(new_events.select(*cols))
        carried = held.interval_days.where(F.col("event_date").isin(days)).join(touched, ["event_date", "ref_no"], "left_anti")
        sums = ["run_seconds", "counter_resets", "capped_intervals", "intervals"]
        intervals = interval_rollup(run_intervals(spliced)).unionByName(carried.select(*ROLLUP_KEYS, *sums))
        counted = held.event_days.where(F.col("event_date").isin(days)).select(*EVENT_ROLLUP_KEYS, "events")
        events = counted.unionByName(event_rollup(new_events)).groupBy(*EVENT_ROLLUP_KEYS).agg(F.sum("events").cast("bigint").alias("events"))
    else:
        base = stored.unionByName(new_events.select(*cols))
        intervals, events = interval_rollup(run_intervals(base)), event_rollup(base)
    rolled_at = F.lit(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    for table, roll in (("interval_days", intervals), ("event_days", events)):
        roll = roll.withColumn("rollup_load_id", F.lit(load_id)).withColumn("rolled_at", rolled_at)
        store.append(table, roll, partition_by=["event_date", "rollup_load_id"])


def materialize(store: Store, t: Tables, load_id: str = "initial") -> None:
    """Write a whole Tables bundle (e.g. the test-table facade) as one committed load."""
    now = F.current_timestamp()
    base = store.manifest()[0]
    store.append("events", t.events.withColumn("loaded_at", now).withColumn("load_id", F.lit(load_id)), ["event_date"])
    write_rollup(store, store.tables().events, store.spark.read.schema(SCHEMAS["events"]).parquet(store.path("events"))
                 .where(F.col("load_id") == load_id), load_id)
    if t.rejected_rows is not None:
        store.append("rejected_rows", t.rejected_rows.withColumn("rejected_at", now).withColumn("load_id", F.lit(load_id)))
    if t.ingestion_runs is not None:
        store.append("ingestion_runs", t.ingestion_runs.select(
            *[F.col(c).cast("timestamp") if c in ("started_at", "finished_at") else F.col(c) for c in t.ingestion_runs.columns]
        ))
    sf = t.source_files.select(
        "file_name", "delivery_date", "data_date", "checksum",
        F.col("first_loaded_at").cast("timestamp").alias("first_loaded_at"),
        F.col("last_loaded_at").cast("timestamp").alias("last_loaded_at"),
        F.col("load_count").cast("int").alias("load_count"),
        F.array(F.lit(load_id)).alias("load_ids"),
        F.lit(None).cast("array<string>").alias("header"),
        F.lit(None).cast("bigint").alias("length"),
        F.lit(None).cast("bigint").alias("modified"),
    )
    store.commit(base, {
        "branches": store.write_version("branches", t.branches),
        "machines": store.write_version("machines", t.machines.withColumn("updated_at", now)),
        "drivers": store.write_version("drivers", t.drivers),
        "source_files": store.write_version("source_files", sf),
    })


def compact_rollups(store: Store) -> int:
    """Delete the folders of superseded rollups and return how many there were.

    A rollup lies in a folder of its date and load.  The newest committed one of each date stays, and so does
    every folder whose load is not committed (it may be running).  Readers that began before a newer commit may
    still hold an older folder, so run this when no such reader is left."""
    t = store.tables()
    committed = {r[0] for r in t.source_files.select(F.explode("load_ids")).distinct().collect()}  # one value a load
    gone = 0
    for table, df in (("interval_days", t.interval_days), ("event_days", t.event_days)):
        if df is None:
            continue
        newest = {(str(r[0]), r[1]) for r in df.select("event_date", "rollup_load_id").distinct().collect()}  # one row a date
        fs, root = store._jvm_fs(store.path(table))
        for day in fs.listStatus(root):
            date = day.getPath().getName().partition("event_date=")[2]
            for load in fs.listStatus(day.getPath()) if date else []:
                load_id = load.getPath().getName().partition("rollup_load_id=")[2]
                if load_id in committed and (date, load_id) not in newest:
                    fs.delete(load.getPath(), True)
                    gone += 1
    return gone
