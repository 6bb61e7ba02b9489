"""Pipeline health: latest runs (F2), per-file quality (E11), the counted summary (E12),
run-hours cross-checks (K2, K3) and the freshness check (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.functions.constants import LOCAL_ZONE
from hourmeter.model import Tables
from hourmeter.operators.intervals import READING_ORDER, machine_daily_hours
from hourmeter.operators.views import rejections_by_reason


def latest_runs(t: Tables) -> DataFrame:
    """the latest run per file (started_at desc, then run_id desc)."""
    w = Window.partitionBy("file_name").orderBy(F.desc("started_at"), F.desc("run_id"))
    return t.ingestion_runs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def _reason_list(by_reason: DataFrame) -> DataFrame:
    """'reason (n), reason (n)' per file, by n desc then reason."""
    return by_reason.groupBy("file_name").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct((-F.col("rows_rejected")).alias("k"), "reason", "rows_rejected"))),
                lambda x: F.concat(x["reason"], F.lit(" ("), x["rows_rejected"].cast("string"), F.lit(")")),
            ),
            ", ",
        ).alias("rejection_reasons")
    )


def data_quality(t: Tables) -> DataFrame:
    """Latest run per file with data day, counts and the rejection reasons."""
    r = latest_runs(t)
    sf = t.source_files.select("file_name", F.col("data_date").alias("data_day"))
    reasons = _reason_list(rejections_by_reason(t))
    return (
        r.join(sf, "file_name", "left")
        .join(reasons, "file_name", "left")
        .select(
            "file_name",
            "data_day",
            "status",
            "rows_read",
            (F.col("rows_loaded") + F.coalesce("rows_already_loaded", F.lit(0))).alias("rows_loaded"),
            "rows_rejected",
            "rejection_reasons",
            F.col("finished_at").alias("last_run_at"),
        )
        .orderBy("file_name")
    )


def _sast_stamp(ts) -> F.Column:
    return F.concat(F.date_format(F.from_utc_timestamp(ts, LOCAL_ZONE), "yyyy-MM-dd HH:mm"), F.lit(" SAST"))


def data_quality_summary(t: Tables) -> DataFrame:
    """(section, item, value, detail) rows with every count done here, not by the reader."""
    r = latest_runs(t)
    files = r.join(t.source_files.select("file_name", "data_date"), "file_name", "left").select(
        "file_name",
        "data_date",
        "status",
        "rows_read",
        (F.col("rows_loaded") + F.coalesce("rows_already_loaded", F.lit(0))).alias("rows_loaded"),
        "rows_rejected",
    )
    span = files.where(F.col("data_date").isNotNull()).agg(F.min("data_date").alias("d0"), F.max("data_date").alias("d1"))
    days = span.where(F.col("d0").isNotNull()).select(F.explode(F.sequence("d0", "d1")).alias("d"))
    ok_days = files.where((F.col("status") == "success") & F.col("data_date").isNotNull()).select(F.col("data_date").alias("d"))
    missing = days.join(ok_days, "d", "left_anti")
    lab = lambda c: X.day_label(c, with_year=False)

    n_days = days.agg(F.count("*").alias("n_all"))
    miss = missing.agg(
        F.count("*").alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list("d")), lambda d: lab(d)), ", ").alias("txt"),
    )
    cov1 = n_days.crossJoin(miss).crossJoin(span).select(
        F.lit("coverage").alias("section"),
        F.lit("days with data").alias("item"),
        (F.col("n_all") - F.col("n")).alias("value"),
        F.concat(X.day_label("d0"), F.lit(" to "), X.day_label("d1")).alias("detail"),
    )
    cov2 = miss.select(
        F.lit("coverage").alias("section"),
        F.lit("missing days").alias("item"),
        F.col("n").alias("value"),
        F.when(F.col("n") > 0, F.col("txt")).otherwise(F.lit("none")).alias("detail"),
    )
    failed = files.where(F.col("status") == "failed").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("file_name")), ", ").alias("txt")
    )
    cov3 = failed.select(
        F.lit("coverage").alias("section"),
        F.lit("failed files").alias("item"),
        F.col("n").alias("value"),
        F.when(F.col("n") > 0, F.col("txt")).otherwise(F.lit("none")).alias("detail"),
    )
    ok = files.where(F.col("status") == "success")
    tot = ok.agg(
        F.sum("rows_read").alias("rr"), F.sum("rows_loaded").alias("rl"), F.sum("rows_rejected").alias("rj")
    )
    totals = [
        tot.select(F.lit("totals").alias("section"), F.lit(item).alias("item"), F.col(c).cast("bigint").alias("value"),
                   F.lit(None).cast("string").alias("detail"))
        for item, c in (("rows read", "rr"), ("rows loaded", "rl"), ("rows rejected", "rj"))
    ]
    rb = rejections_by_reason(t).join(t.source_files.select("file_name", "data_date"), "file_name")
    reasons = rb.groupBy("reason").agg(
        F.sum("rows_rejected").cast("bigint").alias("value"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("data_date", "file_name", "rows_rejected"))),
                lambda x: F.concat(lab(x["data_date"]), F.lit(": "), x["rows_rejected"].cast("string")),
            ),
            ", ",
        ).alias("per_day"),
    )
    rej = reasons.select(
        F.lit("rejections").alias("section"),
        F.col("reason").alias("item"),
        "value",
        F.concat(F.lit("per day: "), F.col("per_day")).alias("detail"),
    )
    fresh = t.ingestion_runs.agg(F.max("finished_at").alias("m")).select(
        F.lit("freshness").alias("section"),
        F.lit("last load").alias("item"),
        F.lit(None).cast("bigint").alias("value"),
        _sast_stamp(F.col("m")).alias("detail"),
    )
    # sections in order; inside a section the rows in the order written here, rejections by total
    out = None
    for place, part in enumerate((cov1, cov2, cov3, *totals, rej, fresh)):
        part = part.withColumn("_place", F.lit(place))
        out = part if out is None else out.unionByName(part)
    by_total = F.when(F.col("section") == "rejections", -F.col("value"))
    return out.orderBy("_place", by_total, "item").drop("_place")


def freshness_check(t: Tables, expected_data_date) -> DataFrame:
    """K7: latest data day of a successful load vs the expected one (one row; sends nothing)."""
    ok = latest_runs(t).where(F.col("status") == "success").join(t.source_files, "file_name")
    return ok.agg(F.max("data_date").alias("latest_data_date")).select(
        F.lit(expected_data_date).cast("date").alias("expected_data_date"),
        "latest_data_date",
        F.coalesce(F.col("latest_data_date") >= F.lit(expected_data_date).cast("date"), F.lit(False)).alias("is_fresh"),
        F.datediff(F.lit(expected_data_date).cast("date"), F.col("latest_data_date")).alias("days_behind"),
    )


def naive_vs_interval_hours(t: Tables, daily: DataFrame | None = None) -> DataFrame:
    """K3: 'last minus first' counter reading per machine-day next to the interval method."""
    e = t.events
    o = F.struct(*READING_ORDER)
    naive = e.groupBy("event_date", "ref_no").agg(
        (F.max_by("run_hours_seconds", o) - F.min_by("run_hours_seconds", o)).alias("naive_seconds"),
        F.count("*").alias("readings"),
    )
    h = daily if daily is not None else machine_daily_hours(t)
    j = naive.join(h.select("event_date", "ref_no", "run_seconds", "counter_resets"), ["event_date", "ref_no"], "left")
    return j.select(
        "event_date",
        "ref_no",
        "readings",
        "naive_seconds",
        X.hours("naive_seconds", 2).alias("naive_hours"),
        F.coalesce("run_seconds", F.lit(0).cast("bigint")).alias("run_seconds"),
        X.hours(F.coalesce("run_seconds", F.lit(0)), 2).alias("run_hours"),
        F.coalesce("counter_resets", F.lit(0).cast("bigint")).alias("counter_resets"),
    )


def reconcile_run_hours(t: Tables, daily: DataFrame | None = None) -> DataFrame:
    """K2: an independent run-hours calculation per machine-day, compared with E1; returns the machine-days
    where the two disagree (none on sound data).  A day without a row in E1 counts as zero there.

    The independent method reads the events once and uses no window.  Readings of a machine at one instant are in counter
    order, so between them no time runs and no counter falls: an instant is its least and greatest counter and how many
    differ, whatever number of readings it holds.  Each hour adds the steps between its instants (at most one a second,
    which is what times are read to) and keeps its first and last, and the day adds the steps between its hours.
    """
    e = t.events.select("ref_no", "event_date", "event_time", "run_hours_seconds")

    def steps(ordered):
        """(seconds, resets, capped) over the neighbours of an array of (from, low, till, high, ...)."""
        pairs = F.transform(
            F.when(F.size(ordered) > 1, F.sequence(F.lit(1), F.size(ordered) - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(
                (F.get(ordered, i)["low"] - F.get(ordered, i - 1)["high"]).alias("up"),
                F.timestamp_diff("SECOND", F.get(ordered, i - 1)["till"], F.get(ordered, i)["from"]).alias("clock"),
            ),
        )
        total = F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["up"] >= 0, F.least(x["up"], x["clock"])).otherwise(0))
        return (
            total,
            F.size(F.filter(pairs, lambda x: x["up"] < 0)).cast("bigint"),
            F.size(F.filter(pairs, lambda x: (x["up"] >= 0) & (x["up"] > x["clock"]))).cast("bigint"),
        )

    different = e.groupBy("event_date", "ref_no", "event_time", "run_hours_seconds").agg(F.lit(1).alias("_one"))
    instants = different.groupBy("event_date", "ref_no", "event_time").agg(F.min("run_hours_seconds").alias("low"), F.max("run_hours_seconds").alias("high"), (F.count(F.lit(1)) - 1).alias("jumps"))
    part = F.struct(F.col("event_time").alias("from"), "low", F.col("event_time").alias("till"), "high")
    hourly = instants.groupBy("event_date", "ref_no", F.hour("event_time").alias("hour")).agg(F.array_sort(F.collect_list(part)).alias("r"), F.sum("jumps").alias("jumps"))
    s, z, c = steps(F.col("r"))
    first, last = F.get("r", 0), F.element_at("r", -1)
    whole = F.struct(first["from"].alias("from"), first["low"].alias("low"), last["till"].alias("till"), last["high"].alias("high"))
    hourly = hourly.select("event_date", "ref_no", s.alias("s"), z.alias("z"), (c + F.col("jumps")).alias("c"), whole.alias("part"))
    days = hourly.groupBy("event_date", "ref_no").agg(F.sum("s").alias("s"), F.sum("z").alias("z"), F.sum("c").alias("c"), F.array_sort(F.collect_list("part")).alias("h"))
    s, z, c = steps(F.col("h"))
    own = days.select("event_date", "ref_no", (F.col("s") + s).alias("js_seconds"), (F.col("z") + z).alias("js_resets"), (F.col("c") + c).alias("js_capped"))
    h = daily if daily is not None else machine_daily_hours(t)
    v = h.select("event_date", "ref_no", F.col("run_seconds").alias("view_seconds"),
                 F.col("counter_resets").alias("view_resets"), F.col("capped_intervals").alias("view_capped"))
    j = own.join(v, ["event_date", "ref_no"], "full_outer")
    none = F.lit(0).cast("bigint")
    names = ["js_seconds", "view_seconds", "js_resets", "view_resets", "js_capped", "view_capped"]
    j = j.select("event_date", "ref_no", *[F.coalesce(n, none).alias(n) for n in names])
    return j.where("js_seconds <> view_seconds or js_resets <> view_resets or js_capped <> view_capped")
