"""Telemetry tables derived from the shared test tables (region, nation, customer, supplier, events).

The test data is a generic star schema with an ``events`` stream.  This facade
re-reads it as fleet telemetry so every operator can run on data whose size
grows with the scale factor:

  branch   <- region            (branch_id = r_regionkey + 1, name = normalised r_name)
  machine  <- customer          (ref_no = 'M' + zero-padded c_custkey, home branch via nation)
  driver   <- supplier          (every supplier; events with k % 10 = 0 have no driver)
  reading  <- events            (time truncated to the second, counter = running sum of
                                 round(value * 100) per machine, wrapping at 50,000 = a reset)

The same mapping is written in SQL in ``hourmeter.plans.contract`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.functions.constants import DAILY_FILE_SUFFIX
from hourmeter.model import Tables, event_types_df
from hourmeter.operators.sliced import sliced_running_sum
from hourmeter.session import ensure_checkpoint_dir

# --- Fixed values: facade mapping tables
SEGMENT_MACHINE_TYPE = [
    ("AUTOMOBILE", "Forklift"),
    ("BUILDING", "Reach Truck"),
    ("FURNITURE", "PPT"),
    ("HOUSEHOLD", "Forklift"),
    ("MACHINERY", "Reach Truck"),
]
# (activity, k % 2) -> event code
ACTIVITY_EVENT_TYPE = [
    ("view", 0, "HEARTBEAT"),
    ("view", 1, "HEARTBEAT"),
    ("signup", 0, "DRIVER_CHANGE"),
    ("signup", 1, "POWER_UP"),
    ("click", 0, "SPEEDING"),
    ("click", 1, "HARSH_ACCELERATION"),
    ("purchase", 0, "HARSH_BRAKING"),
    ("purchase", 1, "EXCESS_IDLE"),
    ("error", 0, "IMPACT"),
    ("error", 1, "IMPACT"),
]
COUNTER_WRAP = 50000
NO_DRIVER_EVERY = 10
OTHER_BRANCH_EVERY = 20
REGION_COUNT = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ref_no_from_id(c) -> F.Column:
    s = F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    return F.concat(F.lit("M"), F.lpad(s, F.greatest(F.lit(6), F.length(s)), "0"))


def _case(col, pairs, default=None):
    expr = None
    for k, v in pairs:
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(default) if default is not None else expr


def facade_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    return r.select((F.col("r_regionkey") + 1).cast("int").alias("branch_id"), X.normalise_branch("r_name").alias("name"))


def facade_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        ref_no_from_id("c_custkey").alias("ref_no"),
        (F.col("n_regionkey") + 1).cast("int").alias("home_branch_id"),
        _case(F.col("c_mktsegment"), SEGMENT_MACHINE_TYPE, "Forklift").alias("machine_type"),
        F.col("c_custkey").alias("_machine_id"),
    )


def facade_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    first = F.regexp_extract("s_name", r"^([^#]*)", 1)
    sur = F.regexp_extract("s_name", r"#0*(\d+)$", 1)
    d = X.normalise_driver(first, sur)
    return s.select(
        F.col("s_suppkey").alias("_driver_no"),
        d["driver_key"].alias("driver_key"),
        d["first_name"].alias("first_name"),
        d["surname"].alias("surname"),
    ).withColumn("display_name", X.display_name("first_name", "surname"))


def file_name_for(delivery_date) -> F.Column:
    return F.concat(F.date_format(delivery_date, "yyyy-MM-dd"), F.lit(DAILY_FILE_SUFFIX))


def facade_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per test event with the telemetry fields (before joins to dimensions)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    t = F.date_trunc("second", "ts").cast("timestamp_ntz")
    base = ev.select(
        "event_id",
        "ts",
        "user_id",
        t.alias("event_time"),
        k.alias("k"),
        F.col("event_type").alias("activity"),
        F.round(F.col("value") * 100).cast("bigint").alias("inc"),
    )
    # running counter per machine: sliced by hour so a hot machine is split across tasks
    counted = sliced_running_sum(
        base,
        keys=["user_id"],
        order=["ts", "event_id"],
        slice_col=F.date_trunc("hour", "ts"),
        value=F.col("inc"),
        out="_counter",
    )
    code = None
    for act, parity, c in ACTIVITY_EVENT_TYPE:
        cond = (F.col("activity") == act) & (F.pmod(F.col("k"), F.lit(2)) == parity)
        code = F.when(cond, c) if code is None else code.when(cond, c)
    return counted.select(
        "event_id",
        "user_id",
        "k",
        ref_no_from_id("user_id").alias("ref_no"),
        "event_time",
        X.event_date("event_time").alias("event_date"),
        code.alias("event_type"),
        F.pmod(F.col("_counter"), F.lit(COUNTER_WRAP)).cast("bigint").alias("run_hours_seconds"),
    )


def facade_events(spark: SparkSession, sf_dir: str, machines: DataFrame, drivers: DataFrame) -> DataFrame:
    r = facade_readings(spark, sf_dir)
    m = machines.select(F.col("_machine_id").alias("user_id"), "home_branch_id")
    d = drivers.select("_driver_no", "driver_key")
    # drivers are dealt over all suppliers; the one-row aggregate tells how many there are
    n = drivers.agg(F.min("_driver_no").alias("_first"), (F.max("_driver_no") - F.min("_driver_no") + 1).alias("_n"))
    r = r.crossJoin(F.broadcast(n)).withColumn(
        "_driver_no",
        F.when(F.pmod("k", F.lit(NO_DRIVER_EVERY)) != 0, F.pmod(F.col("event_id") * 7 + F.col("k"), F.col("_n")) + F.col("_first")),
    )
    j = r.join(m, "user_id").join(d, "_driver_no", "left")
    branch = F.when(
        F.pmod(F.col("event_id"), F.lit(OTHER_BRANCH_EVERY)) == 0, F.pmod(F.col("k"), F.lit(REGION_COUNT)) + 1
    ).otherwise(F.col("home_branch_id"))
    return j.select(
        "ref_no",
        "event_time",
        "event_date",
        "event_type",
        "run_hours_seconds",
        "driver_key",
        branch.cast("int").alias("event_branch_id"),
        file_name_for(F.date_add("event_date", 1)).alias("file_name"),
        (F.col("event_id") + 2).cast("bigint").alias("source_line"),
        F.lit(False).alias("is_late_arrival"),
        (branch != F.col("home_branch_id")).alias("branch_mismatch"),
    )


def facade_source_files(events: DataFrame) -> DataFrame:
    files = events.groupBy("file_name").agg(
        F.max("event_date").alias("data_date")
    )
    return files.select(
        "file_name",
        F.date_add("data_date", 1).alias("delivery_date"),
        "data_date",
        F.lit(None).cast("string").alias("checksum"),
        (F.col("data_date").cast("timestamp_ntz") + F.expr("interval 28 hours")).alias("first_loaded_at"),
        (F.col("data_date").cast("timestamp_ntz") + F.expr("interval 28 hours")).alias("last_loaded_at"),
        F.lit(1).alias("load_count"),
    )


def facade_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The whole star schema over the test tables, lazily planned."""
    branches = facade_branches(spark, sf_dir)
    machines = facade_machines(spark, sf_dir)
    drivers = facade_drivers(spark, sf_dir)
    events = facade_events(spark, sf_dir, machines, drivers)
    return Tables(
        branches=branches,
        machines=machines.drop("_machine_id"),
        drivers=drivers.drop("_driver_no"),
        event_types=event_types_df(spark),
        source_files=facade_source_files(events),
        events=events,
    )


def facade_tables_cut(spark: SparkSession, sf_dir: str) -> Tables:
    """The star schema with its events worked out once, for queries that read them several times."""
    ensure_checkpoint_dir(spark)
    t = facade_tables(spark, sf_dir)
    events = t.events.checkpoint()
    return t.with_(events=events, source_files=facade_source_files(events))


# --- Fixed values: raw-line defects of the CSV facade, by event_id modulus, first match wins.
# Every event still yields its line(s); the modulus only picks which defect a line carries.
DEFECTS = [
    (97, "short_row"),
    (89, "header_text"),
    (83, "blank_ref"),
    (79, "bad_date"),
    (73, "after_delivery"),
    (71, "unknown_ref"),
    (67, "unknown_type"),
    (61, "negative_run_hours"),
    (59, "emitted_twice"),
    (53, "day_first_date"),
    (47, "upper_branch"),
    (43, "spaced_ref"),
    (41, "late_time"),
]
# --- Fixed values: the days of a month whose file is not as it should be, in the folder with gaps
EMPTY_FILE_DAYS = [7]  # delivered without a byte
BROKEN_FILE_DAYS = [11, 22]  # delivered with a header that lacks the required columns
UNDELIVERED_DAYS = [13, 26]
BROKEN_HEADER = "Foo,Bar"
CSV_HEADER = "DateAndTime,RefNo.,BranchName,TxFlagStrings,RunHours,DriverName,DriverSurname"
BRANCH_PREFIX = "acme"  # the company name that the rendered files put before branch names


def facade_raw_lines(spark: SparkSession, sf_dir: str, t: Tables | None = None) -> DataFrame:
    """Daily CSV lines (file_name, line_no, raw_line) rendered from the facade events.

    Line 1 of every file is the header; event ``id`` is written at line 2*id+2
    (and its copy, when emitted twice, at 2*id+3).
    """
    t = t or facade_tables(spark, sf_dir)
    e = t.events
    d = facade_drivers(spark, sf_dir).select("driver_key", F.col("first_name").alias("d_first"), F.col("surname").alias("d_sur"))
    b = t.branches.select(F.col("branch_id").alias("event_branch_id"), F.col("name").alias("b_name"))
    et = F.broadcast(t.event_types.select(F.col("code").alias("event_type"), F.col("label").alias("t_label")))
    j = e.join(b, "event_branch_id").join(et, "event_type").join(d, "driver_key", "left")
    eid = F.col("source_line") - 2
    defect = None
    for m, name in DEFECTS:
        cond = F.pmod(eid, F.lit(m)) == 0
        defect = F.when(cond, name) if defect is None else defect.when(cond, name)
    j = j.withColumn("defect", defect).withColumn("eid", eid)
    dk = F.col("defect")
    t_iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    time_txt = (
        F.when(dk == "bad_date", F.concat(F.lit("31/02/"), F.date_format("event_time", "yyyy"), F.lit(" 10:00:00")))
        .when(dk == "after_delivery", F.date_format(F.col("event_time") + F.expr("interval 2 days"), "yyyy-MM-dd'T'HH:mm:ss"))
        .when(dk == "late_time", F.date_format(F.col("event_time") - F.expr("interval 2 days"), "yyyy-MM-dd'T'HH:mm:ss"))
        .when(dk == "day_first_date", F.date_format("event_time", "dd/MM/yyyy HH:mm:ss"))
        .otherwise(t_iso)
    )
    ref_txt = (
        F.when(dk == "blank_ref", F.lit(""))
        .when(dk == "unknown_ref", F.concat(F.lit("X"), F.col("ref_no")))
        .when(dk == "spaced_ref", F.concat(F.lit(" "), F.lower("ref_no"), F.lit(" ")))
        .otherwise(F.col("ref_no"))
    )
    branch_txt = F.when(dk == "upper_branch", F.concat(F.lit(BRANCH_PREFIX.upper() + "  "), F.upper("b_name"))).otherwise(
        F.concat(F.lit(BRANCH_PREFIX.title() + " "), F.col("b_name"))
    )
    type_txt = F.when(dk == "unknown_type", F.lit("Teleport")).otherwise(F.col("t_label"))
    rh_txt = F.when(dk == "negative_run_hours", F.lit("-5")).otherwise(F.col("run_hours_seconds").cast("string"))
    first_txt = F.coalesce(F.upper("d_first"), F.lit(""))
    sur_txt = F.coalesce(F.col("d_sur"), F.lit(""))
    full = F.concat_ws(",", time_txt, ref_txt, branch_txt, type_txt, rh_txt, first_txt, sur_txt)
    line = (
        F.when(dk == "short_row", F.concat_ws(",", time_txt, ref_txt, branch_txt))
        .when(dk == "header_text", F.lit(CSV_HEADER))
        .otherwise(full)
    )
    copies = F.when(dk == "emitted_twice", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    body = j.select(
        "file_name",
        F.explode(copies).alias("copy"),
        "eid",
        line.alias("raw_line"),
    ).select("file_name", (F.col("eid") * 2 + 2 + F.col("copy")).cast("bigint").alias("line_no"), "raw_line")
    headers = e.select("file_name").distinct().select("file_name", F.lit(1).cast("bigint").alias("line_no"), F.lit(CSV_HEADER).alias("raw_line"))
    return headers.unionByName(body)


def data_day_of_month(file_name="file_name") -> F.Column:
    return F.day(F.date_sub(F.to_date(F.substring(file_name, 1, 10)), 1))


def facade_lines_with_gaps(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same folder after a bad month: (lines, delivered file names).  Some days' files were not delivered,
    some are empty, and some have a useless header; all other lines stay."""
    day = data_day_of_month()
    delivered = lines.where(~day.isin(UNDELIVERED_DAYS))
    names = delivered.select("file_name").distinct()
    text = F.when(day.isin(BROKEN_FILE_DAYS) & (F.col("line_no") == 1), F.lit(BROKEN_HEADER)).otherwise(F.col("raw_line"))
    return delivered.where(~day.isin(EMPTY_FILE_DAYS)).withColumn("raw_line", text), names


def facade_with_gaps(t: Tables) -> Tables:
    """The tables whose registry knows the files that such a folder loads."""
    lost = [*EMPTY_FILE_DAYS, *BROKEN_FILE_DAYS, *UNDELIVERED_DAYS]
    return t.with_(source_files=t.source_files.where(~data_day_of_month().isin(lost)))


def facade_machine_index(t: Tables) -> DataFrame:
    """The machine list as the cleaning rules see it: (ref_no, branch, machine_type)."""
    return t.machines.join(
        t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("branch")), "home_branch_id"
    ).select("ref_no", "branch", "machine_type")


# --- Fixed values: machine-list rendering (header in a non-default column order; defects by machine id)
MACHINE_LIST_HEADER = "MachineType,RefNo.,BranchName"
MACHINE_LIST_FILE = "machine_list.csv"
STALE_COPY_EVERY = 13  # an earlier line with an outdated type and branch: the later line must win
BLANK_REF_EVERY = 17  # an extra line with a blank reference: skipped
SPACED_REF_EVERY = 7  # " m000007 ": trimmed and upper-cased
UPPER_BRANCH_EVERY = 11  # "ACME  HILLSIDE": prefix dropped, title case
BARE_BRANCH_EVERY = 3  # branch written without the company prefix
PADDED_TYPE_EVERY = 5  # "Forklift  ": whitespace collapsed


def facade_machine_list_lines(spark: SparkSession, sf_dir: str, t: Tables | None = None) -> DataFrame:
    """The machine list (A5) as CSV records (file_name, line_no, raw_line), one or more lines per customer.

    Machine ``id`` owns lines 3*id+2 (stale copy), 3*id+3 (blank-ref line) and 3*id+4 (its current line);
    line 1 is the header.  Every machine gets its current line; the moduli only choose the noise.
    """
    t = t or facade_tables(spark, sf_dir)
    m = facade_machines(spark, sf_dir).join(
        t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("b_name")), "home_branch_id"
    )
    mid = F.col("_machine_id")

    def every(n):
        return F.pmod(mid, F.lit(n)) == 0

    ref_txt = F.when(every(SPACED_REF_EVERY), F.concat(F.lit(" "), F.lower("ref_no"), F.lit(" "))).otherwise(F.col("ref_no"))
    branch_txt = (
        F.when(every(UPPER_BRANCH_EVERY), F.concat(F.lit(BRANCH_PREFIX.upper() + "  "), F.upper("b_name")))
        .when(every(BARE_BRANCH_EVERY), F.col("b_name"))
        .otherwise(F.concat(F.lit(BRANCH_PREFIX.title() + " "), F.col("b_name")))
    )
    type_txt = F.when(every(PADDED_TYPE_EVERY), F.concat(F.col("machine_type"), F.lit("  "))).otherwise(F.col("machine_type"))
    stale_type = F.when(F.col("machine_type") == "PPT", F.lit("Forklift")).otherwise(F.lit("PPT"))
    lines = F.array(
        F.struct(F.lit(4).alias("slot"), F.concat_ws(",", type_txt, ref_txt, branch_txt).alias("raw_line")),
        F.when(every(STALE_COPY_EVERY), F.struct(
            F.lit(2).alias("slot"), F.concat_ws(",", stale_type, F.col("ref_no"), F.lit("Acme Old Yard")).alias("raw_line")
        )),
        F.when(every(BLANK_REF_EVERY), F.struct(
            F.lit(3).alias("slot"), F.concat_ws(",", F.col("machine_type"), F.lit(""), F.lit("Acme Nowhere")).alias("raw_line")
        )),
    )
    body = m.select(mid, F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("l")).select(
        F.lit(MACHINE_LIST_FILE).alias("file_name"),
        (mid * 3 + F.col("l.slot")).cast("bigint").alias("line_no"),
        F.col("l.raw_line").alias("raw_line"),
    )
    header = spark.range(1).select(
        F.lit(MACHINE_LIST_FILE).alias("file_name"), F.lit(1).cast("bigint").alias("line_no"), F.lit(MACHINE_LIST_HEADER).alias("raw_line")
    )
    return header.unionByName(body)
