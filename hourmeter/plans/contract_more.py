"""More contract queries: the SQL functions (§2.M), dashboards of a period, picked and changed files and machine lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.plans import contract as C
from hourmeter.plans import snapshot as SN
from hourmeter.plans.contract import register
from hourmeter.plans.contract_sql import SAFETY_NAMES, date_sql, hours_sql, hundredths_sql, rehours_sql, safety_sums_sql
from hourmeter.plans.sql_functions import register_functions
from hourmeter.sources import drift as DR
from hourmeter.sources import payload as PL
from hourmeter.sources.facade import facade_tables, facade_tables_cut

# ---------------------------------------------------------------- M: the questions as SQL functions


def _sql(query: str, loaded: bool = False):
    """The query in ``spark.sql`` over the functions; ``loaded``: over a load with files missing, empty and broken."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        register_functions(spark, C.facade_loaded(spark, sf) if loaded else facade_tables(spark, sf))
        return spark.sql(query)

    return run


register("m2_data_coverage", C.ORACLE["e5_data_coverage"])(_sql("SELECT * FROM data_coverage()"))
register("m2_machine_run_hours", C.ORACLE["e7_machine_run_hours"])(_sql("SELECT * FROM machine_run_hours()"))
register("m2_machine_run_hours_filtered", C.ORACLE["e7_machine_run_hours_filtered"])(
    _sql("SELECT * FROM machine_run_hours(machine_type => 'forklifts', branch => ' Europe ', date_from => DATE '2024-01-08', date_to => DATE '2024-01-14')")
)
register("m2_driver_activity", C.ORACLE["e8_driver_activity"])(_sql("SELECT * FROM driver_activity(driver_name => '  ')"))
register("m2_driver_activity_filtered", C.ORACLE["e8_driver_activity_filtered"])(
    _sql("SELECT * FROM driver_activity(DATE '2024-01-08', DATE '2024-01-21', 'harsh brakes', ' ASIA', driver_name => 'plier 3')")
)
register("m2_branch_summary_week", C.ORACLE["e9_branch_summary_week"])(_sql("SELECT * FROM branch_summary(date_to => DATE '2024-01-21', date_from => DATE '2024-01-15')"))
register("m2_machine_events_filtered", C.ORACLE["e10_machine_events_filtered"])(
    _sql("SELECT * FROM machine_events(DATE '2024-01-01', DATE '2024-01-10', event_type => 'speeding', machine_type => 'pallet truck', branch => 'America')")
)
# the ranking is the function's own: the first rows by the asked event type
register("m2_machine_events_top30_speeding", C.ORACLE["g2_machine_events_top30_speeding"])(_sql("SELECT * FROM machine_events(event_type => 'speed') LIMIT 30"))
register("m2_data_quality", C.ORACLE["e11_data_quality"])(_sql("SELECT * FROM data_quality()", loaded=True))
register("m2_data_quality_summary", C.ORACLE["e12_data_quality_summary"])(_sql("SELECT * FROM data_quality_summary()", loaded=True))


# ---------------------------------------------------------------- I1: the dashboard of a period, in the document's own order

_DATA = ["impacts", "harsh_braking", "harsh_acceleration", "speeding", "excess_idle"]
_KPIS = ["run_hours", "active_machines", "total_machines", "safety_events", "impacts", "active_drivers"]
_NUMBERS = [f"n{i}" for i in range(1, 8)]


def _elements(doc: DataFrame) -> DataFrame:
    """(section, place, k1, k2, n1..n7) of every element of a document; place is its index in the document's array."""

    def section(name: str, source, keys: list, numbers: list):
        def element(x, place):
            k = [x[c].cast("string") for c in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
            n = [x[c].cast("double") for c in numbers] + [F.lit(None).cast("double")] * (7 - len(numbers))
            return F.struct(F.lit(name).alias("section"), place.cast("int").alias("place"), *[v.alias(c) for c, v in zip(["k1", "k2", *_NUMBERS], [*k, *n], strict=True)])

        return F.transform(source, element)

    quality = F.col("data_quality")
    return doc.select(
        F.inline(
            F.concat(
                section("period", F.array(F.col("period")), ["from", "to"], []),
                section("kpis", F.array(F.col("kpis")), [], _KPIS),
                section("rows", F.array(quality), [], ["rows_rejected", "events_without_driver"]),
                section("daily_hours", F.col("daily_hours_by_branch"), ["date", "branch"], ["hours"]),
                section("machine_hours", F.col("machine_hours"), ["ref_no", "branch"], ["hours"]),
                section("safety", F.col("safety_by_branch"), ["branch"], [*_DATA, "total"]),
                section("drivers", F.col("top_drivers"), ["driver_name"], [*_DATA, "total_safety_events", "run_hours"]),
                section("files", quality["files"], ["file_name", "status"], ["rows_read", "rows_loaded", "rows_rejected"]),
            )
        )
    )


_LONGS = ", ".join(f"{n}: BIGINT" for n in _DATA)
_SCHEMA = f"""period STRUCT<`from`: DATE, `to`: DATE>,
kpis STRUCT<run_hours: DOUBLE, active_machines: BIGINT, total_machines: BIGINT, safety_events: BIGINT, impacts: BIGINT, active_drivers: BIGINT>,
daily_hours_by_branch ARRAY<STRUCT<date: DATE, branch: STRING, hours: DOUBLE>>, machine_hours ARRAY<STRUCT<ref_no: STRING, branch: STRING, hours: DOUBLE>>,
safety_by_branch ARRAY<STRUCT<branch: STRING, {_LONGS}, total: BIGINT>>, top_drivers ARRAY<STRUCT<driver_name: STRING, {_LONGS}, total_safety_events: BIGINT, run_hours: DOUBLE>>,
data_quality STRUCT<files: ARRAY<STRUCT<file_name: STRING, status: STRING, rows_read: BIGINT, rows_loaded: BIGINT, rows_rejected: BIGINT>>, rows_rejected: BIGINT, events_without_driver: BIGINT>"""


def _dashboard_sql(a: str, b: str) -> str:
    def section(name: str, keys: list[str], numbers: list[str], source: str, order: str = "") -> str:
        k = [f"CAST({x} AS VARCHAR)" for x in keys] + ["CAST(NULL AS VARCHAR)"] * (2 - len(keys))
        n = [f"CAST({x} AS DOUBLE)" for x in numbers] + ["CAST(NULL AS DOUBLE)"] * (7 - len(numbers))
        place = f"row_number() OVER (ORDER BY {order}) - 1" if order else "0"
        columns = ", ".join(f"{v} AS {c}" for v, c in zip([*k, *n], ["k1", "k2", *_NUMBERS], strict=True))
        return f"SELECT '{name}' AS section, CAST({place} AS INTEGER) AS place, {columns} FROM {source}"

    cut = date_sql("event_date", a, b)
    sums, zeros = safety_sums_sql(), [f"coalesce({n}, 0)" for n in SAFETY_NAMES]
    return C.with_runs(
        f""",
counts AS (SELECT * FROM f_event_counts WHERE {cut}),
mh AS (SELECT ref_no, sum(run_seconds) AS s FROM f_mdh WHERE {cut} GROUP BY ALL),
daily AS (SELECT event_date, operating_branch, {hours_sql('sum(run_seconds)', 1)} AS hours FROM f_mdh WHERE {cut} GROUP BY ALL),
byb AS (SELECT event_branch, {sums} FROM counts GROUP BY ALL),
dh AS (SELECT driver_key, sum(run_hundredths) / 100.0 AS hours FROM f_ddh WHERE {cut} GROUP BY ALL),
byd AS (SELECT * FROM (SELECT driver_key, driver_name, {sums} FROM counts WHERE driver_key IS NOT NULL GROUP BY ALL)
        LEFT JOIN dh USING (driver_key) ORDER BY total_safety_events DESC, driver_name, driver_key LIMIT 8)
"""
        + "\nUNION ALL ".join(
            [
                section("period", [f"'{a}'", f"'{b}'"], [], "(SELECT 1)"),
                section(
                    "kpis",
                    [],
                    _KPIS,
                    f"""(SELECT coalesce({rehours_sql(f"sum({hundredths_sql('s')})")}, 0.0) AS run_hours, count(*) FILTER (WHERE {hundredths_sql('s')} > 0) AS active_machines FROM mh),
  (SELECT count(*) AS total_machines FROM f_machines),
  (SELECT coalesce(sum(event_count) FILTER (WHERE is_safety_event), 0) AS safety_events, coalesce(sum(event_count) FILTER (WHERE event_type = 'IMPACT'), 0) AS impacts,
          count(DISTINCT driver_key) AS active_drivers FROM counts)""",
                ),
                section("rows", [], ["(SELECT count(*) FROM r_rejected)", "coalesce(sum(event_count) FILTER (WHERE is_safety_event AND driver_key IS NULL), 0)"], "counts"),
                section("daily_hours", ["event_date", "operating_branch"], ["hours"], "daily", "event_date, operating_branch"),
                section("machine_hours", ["ref_no", "home_branch"], [f"coalesce({hours_sql('s')}, 0)"], "f_fleet LEFT JOIN mh USING (ref_no)", f"coalesce({hours_sql('s')}, 0) DESC, ref_no"),
                section("safety", ["name"], zeros, "f_branches LEFT JOIN byb ON event_branch = name", "name"),
                section("drivers", ["driver_name"], [*SAFETY_NAMES, "coalesce(hours, 0)"], "byd", "total_safety_events DESC, impacts DESC, driver_name, driver_key"),
                section("files", ["file_name", "status"], ["rows_read", "rows_loaded", "rows_rejected"], "dq", "file_name"),
            ]
        )
    )


def _document(a: str, b: str):
    """The document as the dashboard makes it, with the rollups persisted; they are freed once the rows are cut off."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        shown = SN.dashboard_snapshot(C.facade_loaded(spark, sf), a, b)
        rows = _elements(shown.document()).checkpoint()
        shown.release()
        return rows

    return run


_WEEK, _BEFORE = ("2024-01-08", "2024-01-14"), ("2023-01-01", "2023-12-31")
register("i1_dashboard_document_week", _dashboard_sql(*_WEEK))(_document(*_WEEK))
register("i1_dashboard_document_without_events", _dashboard_sql(*_BEFORE))(_document(*_BEFORE))


def _json_document(spark: SparkSession, sf: str) -> DataFrame:
    text = _sql(f"SELECT * FROM dashboard_snapshot(DATE '{_WEEK[0]}', date_to => DATE '{_WEEK[1]}')", loaded=True)(spark, sf)
    return _elements(text.select(F.from_json("document", _SCHEMA).alias("d")).select("d.*"))


register("m2_dashboard_snapshot_week", _dashboard_sql(*_WEEK))(_json_document)


# ---------------------------------------------------------------- A2, A3, A7, A8, A12: three deliveries, of which one changes files and machines

import datetime as _dt  # noqa: E402
import uuid as _uuid  # noqa: E402

from hourmeter.plans.load import load_records  # noqa: E402
from hourmeter.plans.store import Store  # noqa: E402
from hourmeter.session import ensure_checkpoint_dir  # noqa: E402
from hourmeter.sources import files as FS  # noqa: E402
from hourmeter.sources.facade import BRANCH_PREFIX, data_day_of_month, facade_lines_with_gaps, facade_machine_index, facade_raw_lines  # noqa: E402

CHANGED_DAYS = [5, 15, 25]  # the third delivery's files of these data days end in two more lines
NEW_BRANCH = "Spare Yard"
NEW_LINES = ["T23:59:58,M000001,Acme Spare Yard,Impact,987654321,,", "T23:59:59,GHOST,Acme Spare Yard,Impact,1,,"]  # after the data date
_TIMES = [_dt.datetime(2024, 3, d, 4, 0, 0) for d in (1, 2, 3)]
_DELIVERED: dict[tuple[str, str], str] = {}  # application, data folder -> warehouse folder


def _redelivered(lines: DataFrame) -> DataFrame:
    last = lines.where(data_day_of_month().isin(CHANGED_DAYS)).groupBy("file_name").agg(F.max("line_no").alias("n"))
    date = F.date_format(F.date_sub(F.to_date(F.substring("file_name", 1, 10)), 1), "yyyy-MM-dd")
    texts = F.array(*[F.struct((F.col("n") + k + 1).alias("line_no"), F.concat(date, F.lit(x)).alias("raw_line")) for k, x in enumerate(NEW_LINES)])
    return lines.unionByName(last.select("file_name", F.inline(texts)))


def _changed_list(machines: DataFrame) -> DataFrame:
    """The machine list after a reorganisation: a tenth moved, a tenth of another type, one machine new, the others as they were."""
    tenth = F.pmod(F.substring("ref_no", 2, 9).cast("int"), F.lit(10))
    other = F.when(F.col("machine_type") == "PPT", "Forklift").otherwise("PPT")
    changed = machines.select("ref_no", F.when(tenth == 3, NEW_BRANCH).otherwise(F.col("branch")).alias("branch"), F.when(tenth == 4, other).otherwise(F.col("machine_type")).alias("machine_type"))
    return changed.unionByName(machines.sparkSession.range(1).select(F.lit("M999999").alias("ref_no"), F.lit(NEW_BRANCH).alias("branch"), F.lit("PPT").alias("machine_type")))


def deliveries(spark: SparkSession, sf: str) -> Store:
    """A folder with gaps loaded, loaded again as it is, and loaded once more after some files and the machine list have changed.
    Which files a load picks is left to their fingerprints."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DELIVERED:
        root = ensure_checkpoint_dir(spark).rstrip("/") + "/contract-deliveries-" + _uuid.uuid4().hex
        t = facade_tables_cut(spark, sf)
        first, names = facade_lines_with_gaps(facade_raw_lines(spark, sf, t).checkpoint())
        names, machines = names.checkpoint(), facade_machine_index(t).checkpoint()
        store = Store(spark, root, BRANCH_PREFIX)
        # the second time, the lines come in another order and partitioning
        told = ((first, machines), (first.repartition("raw_line"), machines), (_redelivered(first).checkpoint(), _changed_list(machines)))
        for (lines, listed), at in zip(told, _TIMES, strict=True):
            prints = FS.file_fingerprints(lines.withColumnRenamed("raw_line", "line"))
            candidates = names.join(prints, "file_name", "left").withColumn("checksum", F.coalesce("checksum", F.lit("empty")))
            load_records(spark, store, lines.withColumn("fields", FS.parse_fields(F.col("raw_line"))), candidates, listed, started_at=at)
        _DELIVERED[key] = root
    return Store(spark, _DELIVERED[key], BRANCH_PREFIX)


def _load_no(column: str) -> F.Column:
    return F.coalesce(*[F.when(F.col(column) == F.lit(at), k + 1) for k, at in enumerate(_TIMES)])


_CHANGED_SQL = f"""
changed AS (SELECT * FROM r_outcome WHERE day(CAST(left(file_name, 10) AS DATE) - 1) IN ({', '.join(map(str, CHANGED_DAYS))}) AND status = 'success'),
-- a file's length before the third delivery, which the two new lines follow
ends AS (SELECT file_name, max(line_no) AS n, strftime(CAST(left(file_name, 10) AS DATE) - 1, '%Y-%m-%d') AS d FROM r_lines SEMI JOIN changed USING (file_name) GROUP BY ALL),
added AS (
  SELECT file_name, n + 1 AS line_no, d || 'T23:59:58,M000001,Acme Spare Yard,Impact,987654321,,' AS raw_line FROM ends
  UNION ALL SELECT file_name, n + 2, d || 'T23:59:59,GHOST,Acme Spare Yard,Impact,1,,' FROM ends)
"""

register(
    "a3_picked_deliveries",
    C.with_runs(
        ","
        + _CHANGED_SQL
        + """
SELECT 1 AS load_no, file_name, status, rows_read, rows_loaded, rows_already_loaded, rows_rejected FROM r_outcome
UNION ALL SELECT k, file_name, status, rows_read, rows_loaded, rows_already_loaded, rows_rejected FROM r_outcome, (VALUES (2), (3)) v(k) WHERE status = 'failed'
UNION ALL SELECT 3, file_name, status, rows_read + 2, 1, rows_loaded + rows_already_loaded, rows_rejected + 1 FROM changed"""
    ),
)(lambda spark, sf: deliveries(spark, sf).read("ingestion_runs").select(_load_no("started_at").alias("load_no"), "file_name", "status", "rows_read", "rows_loaded", "rows_already_loaded", "rows_rejected"))

register(
    "a2_a7_registry_after_deliveries",
    C.with_runs(
        ","
        + _CHANGED_SQL
        + """,
held AS (SELECT file_name, raw_line FROM r_lines SEMI JOIN (SELECT * FROM r_outcome WHERE status = 'success') USING (file_name) UNION ALL SELECT file_name, raw_line FROM added)
SELECT file_name, count(*) AS lines, CAST(sum(strlen(raw_line)) AS BIGINT) AS bytes,
       CASE WHEN file_name IN (SELECT file_name FROM changed) THEN 2 ELSE 1 END AS load_count
FROM held GROUP BY file_name"""
    ),
)(
    lambda spark, sf: deliveries(spark, sf).tables().source_files.select(
        "file_name", F.split("checksum", "-")[1].cast("bigint").alias("lines"), F.split("checksum", "-")[2].cast("bigint").alias("bytes"), "load_count"
    )
)


def _rejections(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored rejection with the load that stored it: a line rejected before keeps its first row."""
    store = deliveries(spark, sf)
    loads = store.read("ingestion_runs").select(F.col("run_id").alias("load_id"), _load_no("started_at").alias("load_no")).distinct()
    return store.tables().rejected_rows.join(loads, "load_id").select("load_no", "file_name", "line_no", "raw_line", "reason", "detail")


register(
    "a12_rejections_after_deliveries",
    C.with_runs(
        ","
        + _CHANGED_SQL
        + """
SELECT 1 AS load_no, file_name, line_no, raw_line, reason, detail FROM r_rejected
UNION ALL SELECT 3, file_name, line_no, raw_line, 'machine_not_in_machine_list', 'GHOST' FROM added WHERE raw_line LIKE '%GHOST%'"""
    ),
)(_rejections)


def _machines(spark: SparkSession, sf: str) -> DataFrame:
    t = deliveries(spark, sf).tables()
    first = t.machines.agg(F.min("updated_at").alias("first"))  # one row
    named = t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("home_branch"))
    return t.machines.join(named, "home_branch_id").crossJoin(first).select("ref_no", "home_branch", "machine_type", F.when(F.col("updated_at") == F.col("first"), 1).otherwise(3).alias("changed_in_load"))


register(
    "a8_machines_after_changed_list",
    C.with_runs(
        f""",
listed AS (SELECT *, CAST(substr(ref_no, 2) AS INTEGER) % 10 AS tenth FROM r_machines)
SELECT ref_no, CASE WHEN tenth = 3 THEN '{NEW_BRANCH}' ELSE branch END AS home_branch,
       CASE WHEN tenth <> 4 THEN machine_type WHEN machine_type = 'PPT' THEN 'Forklift' ELSE 'PPT' END AS machine_type,
       CASE WHEN tenth IN (3, 4) THEN 3 ELSE 1 END AS changed_in_load
FROM listed UNION ALL SELECT 'M999999', '{NEW_BRANCH}', 'PPT', 3"""
    ),
)(_machines)


# ---------------------------------------------------------------- K1: a feed of readings, shuffled and repeated over micro-batches

from hourmeter.plans.store import materialize  # noqa: E402
from hourmeter.streaming.readings import READING, stream_readings  # noqa: E402

FEED_DELIVERIES = 3  # one a micro-batch
FEED_FILE_ROWS = 200_000  # a delivery has as many files as its readings need, so no task writes or reads a whole one


def _feed_state(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading in one of three deliveries by hash, two thirds again in the next one; the stream takes a delivery at a time."""
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/contract-feed-" + _uuid.uuid4().hex
    t = facade_tables_cut(spark, sf)
    place = F.pmod(F.xxhash64("ref_no", "source_line"), F.lit(FEED_DELIVERIES))
    person = t.drivers.select("driver_key", "first_name", "surname")
    named = t.branches.select(F.col("branch_id").alias("event_branch_id"), F.col("name").alias("branch"))
    columns = [c.strip().split()[0] for c in READING.split(",")]
    files = -(-t.events.count() // FEED_FILE_ROWS) or 1
    for k in range(FEED_DELIVERIES):  # the file source takes files by the time they were written
        again = (F.pmod("source_line", F.lit(3)) > 0) & ((place + 1) % FEED_DELIVERIES == k)
        delivered = t.events.where((place == k) | again).withColumn("seq", F.col("source_line").cast("bigint"))
        delivered = delivered.join(named, "event_branch_id").join(person, "driver_key", "left").select(*columns)
        delivered.repartition(files, "seq").sortWithinPartitions(F.xxhash64("seq")).write.mode("append").parquet(root + "/feed")
    store = Store(spark, root + "/warehouse", BRANCH_PREFIX)
    materialize(store, t.with_(events=t.events.limit(0), source_files=t.source_files.limit(0)), load_id="start")
    stream = spark.readStream.schema(READING).option("maxFilesPerTrigger", str(files)).parquet(root + "/feed")
    stream_readings(spark, store, stream, "feed", root + "/stream-ckpt").awaitTermination()
    e = store.tables()
    names = e.branches.select(F.col("branch_id").alias("event_branch_id"), F.col("name").alias("branch"))
    return e.events.join(names, "event_branch_id").select("ref_no", "event_time", "event_type", "run_hours_seconds")


register(
    "k1_stream_readings_state",
    C.with_facade("SELECT DISTINCT ref_no, event_time, event_type, run_hours_seconds FROM f_events"),
)(_feed_state)


# ---------------------------------------------------------------- I2: documents whose shape has drifted


def _drifting(spark: SparkSession, sf: str) -> DR.DriftingPayload:
    """The cleaned rows as block documents, with fields added, mistyped and left out by the rows' line numbers."""
    _, c = C.facade_cleaned(spark, sf)
    docs = PL.payload_documents(c.rows, c.rejected).select(F.from_json("value", PL.PAYLOAD_SCHEMA).alias("p")).select("p.*")

    def row(r):
        n = r["source_line"]
        hours = F.when(n % 5 == 0, F.concat(F.lit('"'), r["run_hours_seconds"], F.lit(' h"'))).when(n % 13 == 0, F.concat(F.lit('"'), r["run_hours_seconds"], F.lit('"')))
        return F.struct(
            F.when(n % 17 != 0, r["ref_no"]).alias("ref_no"),
            F.parse_json(F.coalesce(hours, r["run_hours_seconds"].cast("string"))).alias("run_hours_seconds"),
            F.when(n % 11 == 0, F.to_variant_object(F.array(r["driver"]["driver_key"]))).otherwise(
                F.parse_json(F.to_json(r["driver"]))).alias("driver"),
            F.when(n % 7 == 0, F.struct(n.alias("v"))).alias("firmware"),
            n.alias("source_line"),
            *[r[x] for x in ("event_time", "event_type", "reported_branch", "is_late_arrival", "branch_mismatch")],
        )

    def line(x):
        return F.struct(F.when(x["line_no"] % 3 == 0, "night").alias("shift"), x["line_no"], x["raw_line"], x["reason"], x["detail"])

    first = F.least(F.array_min(F.col("rows.source_line")), F.array_min(F.col("rejected.line_no")))
    sender = F.when(F.floor(first / PL.PAYLOAD_BLOCK_LINES) % 2 == 0, "depot").alias("sender")
    planted = F.struct("file", F.transform("rows", row).alias("rows"), F.transform("rejected", line).alias("rejected"), sender)
    return DR.explode_drifting(docs.select(F.to_json(planted).alias("value")).checkpoint(), cut=lambda df: df.checkpoint())


_DRIFT_SQL = f"""
, placed AS (SELECT *, row_number() OVER (PARTITION BY file_name, source_line // {PL.PAYLOAD_BLOCK_LINES} ORDER BY source_line) - 1 AS place FROM r_rows),
cut AS (SELECT *, row_number() OVER (PARTITION BY file_name, line_no // {PL.PAYLOAD_BLOCK_LINES} ORDER BY line_no) - 1 AS place FROM r_rejected),
blocks AS (SELECT DISTINCT file_name, source_line // {PL.PAYLOAD_BLOCK_LINES} AS block FROM r_rows
           UNION SELECT DISTINCT file_name, line_no // {PL.PAYLOAD_BLOCK_LINES} FROM r_rejected)
SELECT file_name, 'rows' AS section, place, 'run_hours_seconds' AS field, 'mistyped' AS kind, '"' || run_hours_seconds || ' h"' AS value
FROM placed WHERE source_line % 5 = 0
UNION ALL SELECT file_name, 'rows', place, 'driver', 'mistyped', CASE WHEN driver_key IS NULL THEN '[null]' ELSE '["' || driver_key || '"]' END FROM placed WHERE source_line % 11 = 0
UNION ALL SELECT file_name, 'rows', place, 'firmware', 'extra', '{{"v":' || source_line || '}}' FROM placed WHERE source_line % 7 = 0
UNION ALL SELECT file_name, 'rows', place, 'ref_no', 'missing', NULL FROM placed WHERE source_line % 17 = 0
UNION ALL SELECT file_name, 'rejected', place, 'shift', 'extra', '"night"' FROM cut WHERE line_no % 3 = 0
UNION ALL SELECT file_name, 'document', -1, 'sender', 'extra', '"depot"' FROM blocks WHERE block % 2 = 0
"""

_DRIFTED_ROWS_SQL = """
SELECT file_name, source_line, ref_no, event_time, event_type, CASE WHEN source_line % 5 <> 0 THEN run_hours_seconds END AS run_hours_seconds,
       reported_branch, CASE WHEN source_line % 11 <> 0 THEN driver_first_name END AS driver_first_name,
       CASE WHEN source_line % 11 <> 0 THEN driver_surname END AS driver_surname, CASE WHEN source_line % 11 <> 0 THEN driver_key END AS driver_key,
       is_late_arrival, branch_mismatch
FROM r_rows WHERE source_line % 17 <> 0
"""

register("i2_payload_drift", C.with_clean(_DRIFT_SQL))(lambda spark, sf: _drifting(spark, sf).drift.drop("element"))
register("i2_payload_drifted_rows", C.with_clean(_DRIFTED_ROWS_SQL))(
    lambda spark, sf: _drifting(spark, sf).rows.select(
        "file_name", "source_line", "ref_no", "event_time", "event_type", "run_hours_seconds", "reported_branch",
        F.col("driver.first_name").alias("driver_first_name"), F.col("driver.surname").alias("driver_surname"),
        F.col("driver.driver_key").alias("driver_key"), "is_late_arrival", "branch_mismatch",
    )
)
