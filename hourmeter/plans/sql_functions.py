"""SQL functions for SQL users: the questions as table functions with optional arguments.

``register_functions`` registers the named views (M1), a few more that the questions need, and on top of them

  machine_run_hours(date_from, date_to, machine_type, branch, ref_no)               E7
  driver_activity(date_from, date_to, event_type, branch, driver_name)              E8
  branch_summary(date_from, date_to)                                                E9
  machine_events(date_from, date_to, event_type, machine_type, branch, ref_no)      E10
  data_coverage()  data_quality()  data_quality_summary()                           E5, E11, E12
  dashboard_snapshot(date_from, date_to)                                            I1, as one JSON document
  norm_machine_type(p)  norm_event_type(p)                                          C9, C10

as temporary functions of the session.  Every argument is optional (NULL or blank: no filter) and can be given by name:
``SELECT * FROM machine_run_hours(machine_type => 'forklifts', date_from => DATE '2024-01-08')``.

The bodies are plain SQL over the views, which Catalyst inlines: constant arguments fold, so a filter that isn't given is
gone from the plan and a date filter reaches the stored rollups' scans as a partition filter.  Each question is ordered as
its DataFrame form is, and its values come from the same integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.functions.constants import EVENT_TYPE_PARTS, MACHINE_TYPE_STARTS, NO_DRIVER, SAFETY_COLUMNS, UNKNOWN_FILTER
from hourmeter.model import Tables
from hourmeter.operators import quality as QL
from hourmeter.operators import views as V
from hourmeter.plans.views import register_views

_NAMES = [name for _, name in SAFETY_COLUMNS] + ["total_safety_events"]
_DATES = "date_from DATE DEFAULT NULL, date_to DATE DEFAULT NULL"


def _text_case(pairs: list[tuple[str, str]], like: str) -> str:
    whens = " ".join(f"WHEN lower(p) LIKE '{like.format(text)}' THEN '{meaning}'" for text, meaning in pairs)
    return f"CASE WHEN p IS NULL OR trim(p) = '' THEN NULL {whens} ELSE '{UNKNOWN_FILTER}' END"


def _between(function: str, column: str) -> str:
    """A range whose open ends fold away."""
    return f"({function}.date_from IS NULL OR {column} >= {function}.date_from) AND ({function}.date_to IS NULL OR {column} <= {function}.date_to)"


def _asked(argument: str, condition: str) -> str:
    return f"({argument} IS NULL OR trim({argument}) = '' OR {condition})"


def _safety_sums(zero: bool) -> str:
    sums = [f"sum(event_count) FILTER (WHERE event_type = '{code}') AS {name}" for code, name in SAFETY_COLUMNS]
    sums.append("sum(event_count) FILTER (WHERE is_safety_event) AS total_safety_events")
    return ", ".join("coalesce(" + s.replace(" AS ", ", 0L) AS ") if zero else s for s in sums)


def _ranked_by(function: str) -> str:
    """The count that an event type asks for; any other text ranks by the total."""
    whens = " ".join(f"WHEN '{code}' THEN {name}" for code, name in SAFETY_COLUMNS)
    return f"CASE norm_event_type({function}.event_type) {whens} ELSE total_safety_events END AS asked"


def _of_machine(function: str) -> str:
    """The filters on a machine's type, home branch and ref."""
    return " AND ".join(
        [
            f"(norm_machine_type({function}.machine_type) IS NULL OR m.machine_type = norm_machine_type({function}.machine_type))",
            _asked(f"{function}.branch", f"lower(m.home_branch) = lower(trim({function}.branch))"),
            _asked(f"{function}.ref_no", f"m.ref_no = upper(trim({function}.ref_no))"),
        ]
    )


def _objects(name: str, columns: list[str], source: str, order: list[str]) -> str:
    """One row with an array of objects in order, empty where there are no rows.  ``order`` has columns, or numbers to be descended."""
    keys = ", ".join(f"{o} AS k{i}" for i, o in enumerate(order))
    fields = ", ".join(columns)
    return f"(SELECT transform(array_sort(collect_list(struct({keys}, struct({fields}) AS o))), x -> x.o) AS {name} FROM {source})"


def _run_hours(function: str, where: str = "TRUE") -> str:
    return f"""(SELECT ref_no, machine_type, home_branch, CAST(h / 100D AS DOUBLE) AS run_hours, h AS run_hundredths, n AS days_with_activity
        FROM (SELECT m.ref_no, m.machine_type, m.home_branch, hour_units(sum(m.run_seconds), 100L) AS h, count_if(m.run_seconds > 0) AS n
              FROM v_machine_daily_hours m WHERE {_between(function, "m.event_date")} AND {where} GROUP BY m.ref_no, m.machine_type, m.home_branch))"""


def _activity(function: str, where: str = "TRUE") -> str:
    return f"""(SELECT c.*, CAST(coalesce(h, 0L) / 100D AS DOUBLE) AS run_hours
        FROM (SELECT driver_name, driver_key, {_safety_sums(True)} FROM v_event_counts c WHERE {_between(function, "event_date")} AND {where} GROUP BY driver_name, driver_key) c
        LEFT JOIN (SELECT driver_key, sum(run_hundredths) AS h FROM v_driver_daily_hours WHERE {_between(function, "event_date")} GROUP BY driver_key) d
          ON d.driver_key <=> c.driver_key)"""


def _branches(function: str) -> str:
    zeros = ", ".join(f"coalesce(e.{n}, 0L) AS {n}" for n in _NAMES)
    return f"""(SELECT b.name AS branch, CAST(coalesce(hour_units(h.s, 100L), 0L) / 100D AS DOUBLE) AS run_hours, coalesce(h.n, 0L) AS active_machines, {zeros}
        FROM v_branches b
        LEFT JOIN (SELECT operating_branch, sum(run_seconds) AS s, count(DISTINCT ref_no) FILTER (WHERE run_seconds > 0) AS n
                   FROM v_machine_daily_hours WHERE {_between(function, "event_date")} GROUP BY operating_branch) h ON h.operating_branch = b.name
        LEFT JOIN (SELECT event_branch, {_safety_sums(False)} FROM v_event_counts WHERE {_between(function, "event_date")} GROUP BY event_branch) e
          ON e.event_branch = b.name)"""


def _machines(function: str) -> str:
    zeros = ", ".join(f"coalesce(e.{n}, 0L) AS {n}" for n in _NAMES)
    return f"""(SELECT m.ref_no, m.machine_type, m.home_branch, {zeros}
        FROM v_machines m
        LEFT JOIN (SELECT ref_no, {_safety_sums(False)} FROM v_event_counts WHERE {_between(function, "event_date")} GROUP BY ref_no) e ON e.ref_no = m.ref_no
        WHERE {_of_machine(function)})"""


def _functions() -> dict[str, str]:
    """name(arguments) RETURNS ... -> body, in the order in which they build on each other.  A function hands its arguments to
    no other table function (Spark inlines one level), so the dashboard shares these texts instead."""
    names = ", ".join(_NAMES)
    longs = ", ".join(f"{n} BIGINT" for n in _NAMES)
    of_branch = _asked("driver_activity.branch", "lower(c.event_branch) = lower(trim(driver_activity.branch))")
    of_driver = _asked("driver_activity.driver_name", "driver_name ILIKE concat('%', trim(driver_activity.driver_name), '%')")
    return {
        "norm_machine_type(p STRING) RETURNS STRING": _text_case(MACHINE_TYPE_STARTS, "{}%"),
        "norm_event_type(p STRING) RETURNS STRING": _text_case(EVENT_TYPE_PARTS, "%{}%"),
        # whole 10^-digits hours, rounded half away from zero in integers
        "hour_units(seconds BIGINT, scale BIGINT) RETURNS BIGINT": "CAST(sign(seconds) AS BIGINT) * ((abs(seconds) * scale + 1800) div 3600)",
        "data_coverage() RETURNS TABLE (event_date DATE, day_name STRING, events BIGINT, active_machines BIGINT)": "SELECT * FROM v_data_coverage ORDER BY event_date",
        f"""machine_run_hours({_DATES}, machine_type STRING DEFAULT NULL, branch STRING DEFAULT NULL, ref_no STRING DEFAULT NULL)
        RETURNS TABLE (ref_no STRING, machine_type STRING, home_branch STRING, run_hours DOUBLE, run_hundredths BIGINT, days_with_activity BIGINT)""": f"""
        SELECT * FROM {_run_hours("machine_run_hours", _of_machine("machine_run_hours"))} ORDER BY run_hundredths DESC, ref_no""",
        f"""driver_activity({_DATES}, event_type STRING DEFAULT NULL, branch STRING DEFAULT NULL, driver_name STRING DEFAULT NULL)
        RETURNS TABLE (driver_name STRING, {longs}, run_hours DOUBLE, driver_key STRING)""": f"""
        SELECT driver_name, {names}, run_hours, driver_key
        FROM (SELECT *, {_ranked_by("driver_activity")} FROM {_activity("driver_activity", of_branch)} WHERE {of_driver})
        ORDER BY asked DESC, driver_name, driver_key""",
        f"branch_summary({_DATES}) RETURNS TABLE (branch STRING, run_hours DOUBLE, active_machines BIGINT, {longs})": f"""
        SELECT * FROM {_branches("branch_summary")} ORDER BY branch""",
        f"""machine_events({_DATES}, event_type STRING DEFAULT NULL, machine_type STRING DEFAULT NULL, branch STRING DEFAULT NULL, ref_no STRING DEFAULT NULL)
        RETURNS TABLE (ref_no STRING, machine_type STRING, home_branch STRING, {longs})""": f"""
        SELECT ref_no, machine_type, home_branch, {names} FROM (SELECT *, {_ranked_by("machine_events")} FROM {_machines("machine_events")}) ORDER BY asked DESC, ref_no""",
    }


def _health_functions() -> dict[str, str]:
    """The functions that need the run log and the quarantine."""
    own = "dashboard_snapshot"
    between = _between(own, "event_date")
    shown = [f"{n} AS {'total' if n == 'total_safety_events' else n}" for n in _NAMES]
    top = f"(SELECT * FROM {_activity(own)} WHERE driver_name <> '{NO_DRIVER}' ORDER BY total_safety_events DESC, driver_name, driver_key LIMIT 8)"
    daily = f"""(SELECT event_date, day_name, operating_branch, CAST(hour_units(s, 10L) / 10D AS DOUBLE) AS hours
                 FROM (SELECT event_date, day_name, operating_branch, sum(run_seconds) AS s FROM v_machine_daily_hours WHERE {between} GROUP BY event_date, day_name, operating_branch))"""
    hours = f"(SELECT m.*, coalesce(h.run_hours, 0D) AS hours FROM v_machines m LEFT JOIN {_run_hours(own)} h ON h.ref_no = m.ref_no)"
    # every section is a table of one row: arguments reach tables in FROM, but no subquery inside an expression
    sections = [
        "(SELECT struct(coalesce(dashboard_snapshot.date_from, first_day) AS `from`, coalesce(dashboard_snapshot.date_to, last_day) AS `to`) AS period FROM (SELECT min(event_date) AS first_day, max(event_date) AS last_day FROM v_available_days))",
        f"(SELECT coalesce(((sum(run_hundredths) + 5) div 10) / 10D, 0D) AS run_hours, count_if(run_hundredths > 0) AS active_machines FROM {_run_hours(own)})",
        "(SELECT count(*) AS total_machines FROM v_machines)",
        f"""(SELECT coalesce(sum(event_count) FILTER (WHERE is_safety_event), 0L) AS safety_events, coalesce(sum(event_count) FILTER (WHERE event_type = 'IMPACT'), 0L) AS impacts,
              count(DISTINCT driver_key) AS active_drivers, coalesce(sum(event_count) FILTER (WHERE is_safety_event AND driver_key IS NULL), 0L) AS events_without_driver
             FROM v_event_counts WHERE {between})""",
        _objects("daily_hours_by_branch", ["event_date AS date", "day_name AS day", "operating_branch AS branch", "hours"], daily, ["event_date", "operating_branch"]),
        _objects("machine_hours", ["ref_no", "machine_type AS type", "home_branch AS branch", "hours"], hours, ["-hours", "ref_no"]),
        _objects("safety_by_branch", ["branch", *shown], _branches(own), ["branch"]),
        _objects("top_drivers", ["driver_name", *_NAMES, "run_hours"], top, ["-total_safety_events", "-impacts", "driver_name", "driver_key"]),
        _objects("files", ["file_name", "data_day", "status", "rows_read", "rows_loaded", "rows_rejected", "rejection_reasons", "last_run_at"], "v_data_quality", ["file_name"]),
        "(SELECT coalesce(sum(rows_rejected), 0L) AS rows_rejected FROM v_rejections_by_reason)",
        "(SELECT max(last_run_at) AS last_run_at FROM v_data_quality)",
    ]
    document = """named_struct('generated_at', current_timestamp(), 'period', period,
        'kpis', struct(run_hours, active_machines, total_machines, safety_events, impacts, active_drivers),
        'daily_hours_by_branch', daily_hours_by_branch, 'machine_hours', machine_hours, 'safety_by_branch', safety_by_branch, 'top_drivers', top_drivers,
        'data_quality', struct(files, rows_rejected, last_run_at, events_without_driver))"""
    return {
        """data_quality() RETURNS TABLE (file_name STRING, data_day DATE, status STRING, rows_read BIGINT, rows_loaded BIGINT,
        rows_rejected BIGINT, rejection_reasons STRING, last_run_at TIMESTAMP_NTZ)""": "SELECT * FROM v_data_quality ORDER BY file_name",
        "data_quality_summary() RETURNS TABLE (section STRING, item STRING, value BIGINT, detail STRING)": "SELECT section, item, value, detail FROM v_data_quality_summary",
        f"dashboard_snapshot({_DATES}) RETURNS TABLE (document STRING)": f"SELECT to_json({document}) FROM {' CROSS JOIN '.join(sections)}",
    }


def register_functions(spark: SparkSession, t: Tables) -> list[str]:
    """Register the views and functions over ``t`` in this session; returns the functions' names.  Called again, it replaces
    both.  Without a run log or quarantine in ``t``, the three functions about files and the dashboard are left out."""
    register_views(spark, t)
    home = t.branches.select(F.col("branch_id").alias("home_branch_id"), F.col("name").alias("home_branch"))
    more: dict[str, DataFrame] = {
        "v_branches": t.branches.select("branch_id", "name"),
        "v_machines": t.machines.join(home, "home_branch_id").select("ref_no", "machine_type", "home_branch"),
        "v_data_coverage": V.data_coverage(t),
    }
    functions = _functions()
    if t.ingestion_runs is not None and t.rejected_rows is not None:
        quality = QL.data_quality(t)
        more["v_data_quality"] = quality.withColumn("last_run_at", F.col("last_run_at").cast("timestamp_ntz"))
        more["v_data_quality_summary"] = QL.data_quality_summary(t)
        functions |= _health_functions()
    for name, df in more.items():
        df.createOrReplaceTempView(name)
    for head, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.partition("(")[0] for head in functions]
