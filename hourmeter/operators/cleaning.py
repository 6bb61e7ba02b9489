"""Cleaning rules (B1-B14): one pass, the first failing rule gives the reason.

Input: parsed records (file_name, line_no, raw_line, fields) and a machine index
(ref_no, branch, machine_type).  Output (``Cleaned``):

  rows      clean, typed events (FIXTURES.md section 2 schema)
  rejected  file_name, line_no, raw_line, reason, detail
  summary   per file: rows_read, rows_clean, rows_rejected, rejected_by_reason,
            late_arrival_rows, branch_mismatch_rows
  failures  files that cannot be read at all: file_name, error

Rule order: repeated header, column count, missing value, timestamp, after
delivery, unknown machine, unknown type, run hours, then in-file duplicate
among rows that passed the others.  The duplicate rule is an aggregate
(first line per key) joined back, not a per-key window, so a key with a huge
number of copies is combined map-side and split by AQE's skew join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.functions.constants import HEADER_ALIASES, REQUIRED_COLUMNS


@dataclass
class Cleaned:
    classified: DataFrame
    headers: DataFrame
    failures: DataFrame

    @property
    def rows(self) -> DataFrame:
        c = self.classified.where(F.col("reason").isNull())
        return c.select(
            "file_name",
            "delivery_date",
            "data_date",
            F.col("line_no").alias("source_line"),
            "ref_no",
            "event_time",
            F.col("code").alias("event_type"),
            F.col("rh_value").alias("run_hours_seconds"),
            "reported_branch",
            "driver",
            "is_late_arrival",
            "branch_mismatch",
        )

    @property
    def rejected(self) -> DataFrame:
        return self.classified.where(F.col("reason").isNotNull()).select(
            "file_name", "line_no", "raw_line", "reason", "detail"
        )

    @property
    def summary(self) -> DataFrame:
        return clean_summary(self)

    def persist(self) -> "Cleaned":
        self.classified = self.classified.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        self.classified.unpersist()


def _alias_map():
    pairs = []
    for k, v in HEADER_ALIASES.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def file_headers(records: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """B1: one row per file with the header map, or the reason the file fails.

    Columns: file_name, hline, n_cols, signature, i_<role> (1-based, last duplicate
    wins), error.  ``files`` (file_name) lets empty files be reported too.
    """
    # the first line numbers first, one row a file, then their fields: no record but those is sorted or kept
    first = records.groupBy("file_name").agg(F.min("line_no").alias("hline"))
    at = F.broadcast(first.select(F.col("file_name").alias("_file"), "hline"))
    found = records.join(at, F.col("file_name").eqNullSafe(F.col("_file")) & (F.col("line_no") == F.col("hline")))
    found = found.groupBy("_file").agg(F.min_by("fields", "line_no").alias("h"))
    hdr = first.join(found, F.col("file_name").eqNullSafe(F.col("_file")), "left").drop("_file")
    keys = F.transform(F.col("h"), lambda s: X.header_key(s))
    roles = F.transform(keys, lambda k: F.element_at(_alias_map(), k))
    out = hdr.select(
        "file_name",
        "hline",
        F.col("h").alias("header"),
        F.size("h").alias("n_cols"),
        F.array_join(keys, "|").alias("signature"),
        roles.alias("roles"),
    )
    for r in REQUIRED_COLUMNS:
        pos_rev = F.array_position(F.reverse(F.col("roles")), r)
        out = out.withColumn("i_" + r, F.when(pos_rev > 0, (F.size("roles") - pos_rev + 1).cast("int")))
    present = F.array_compact(F.col("roles"))  # array_contains is null-aware: drop the unknown columns first
    missing = F.filter(F.array(*[F.lit(r) for r in REQUIRED_COLUMNS]), lambda r: ~F.array_contains(present, r))
    out = out.withColumn(
        "error",
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing required column(s): "), F.array_join(missing, ", "))),
    ).drop("roles")
    if files is not None:
        empty = files.select("file_name").join(out.select("file_name"), "file_name", "left_anti")
        out = out.unionByName(empty.withColumn("error", F.lit("File is empty")), allowMissingColumns=True)
    return out


def clean_records(
    records: DataFrame,
    machines: DataFrame,
    event_types: DataFrame,
    files: DataFrame | None = None,
    branch_prefix: str = "",
    cut=None,
) -> Cleaned:
    """Classify every data record of every readable file.

    ``cut`` (e.g. ``DataFrame.checkpoint``) is applied to the parsed records and to
    the frame before the duplicate rule: both are read by two branches (header map
    and data; first line per key and the join back), so cutting there keeps the
    plan small and gives the consumers one stable, recoverable input.
    """
    if cut is not None:
        records = cut(records)
    headers = file_headers(records, files)
    ok = headers.where(F.col("error").isNull()).drop("error")
    failures = headers.where(F.col("error").isNotNull()).select("file_name", "error")

    # one row a file, whose names the driver lists anyway: the records are not dealt by file to meet it, and the
    # dates in a name are taken from it once
    by_file = ok.drop("header").withColumn("delivery_date", X.delivery_date_from_name("file_name")).withColumn(
        "data_date", X.data_date_from_name("file_name")
    )
    data = records.join(F.broadcast(by_file), "file_name").where(F.col("line_no") > F.col("hline"))

    def get(role):
        return F.try_element_at("fields", F.col("i_" + role))

    # header keys hold no "|", so equal texts have equal parts: only a record like the header in size and first part is compared
    like_header = (F.size("fields") == F.col("n_cols")) & (
        X.header_key(F.try_element_at("fields", F.lit(1))) == F.substring_index("signature", "|", 1)
    )
    is_header = F.array_join(F.transform("fields", lambda s: X.header_key(s)), "|") == F.col("signature")

    d = data.select(
        "file_name",
        "line_no",
        "raw_line",
        "delivery_date",
        "data_date",
        F.when(like_header, is_header).otherwise(False).alias("is_header"),
        F.size("fields").alias("n_got"),
        "n_cols",
        X.normalise_ref(get("ref_no")).alias("ref_no"),
        X.collapse(get("event_type")).alias("type_raw"),
        X.collapse(get("event_time")).alias("time_raw"),
        X.collapse(get("run_hours")).alias("rh_raw"),
        X.without_prefix(X.collapse(get("branch")), branch_prefix).alias("_branch"),
        X.collapse(get("driver_first_name")).alias("_first"),
        X.collapse(get("driver_surname")).alias("_surname"),
    )
    # step by step, so that no text is normalised once for every place that uses it
    d = d.withColumns({
        "branch_norm": F.when(F.col("_branch") != "", X.raised("_branch")),
        "_first": X.raised("_first"),
        "_surname": X.raised("_surname"),
        "event_time": X.event_time_of("time_raw"),
        "rh_value": F.when(F.col("rh_raw").rlike(r"^[0-9]+$"), F.col("rh_raw").try_cast("bigint")),
    })
    d = d.withColumn("driver", X.driver_of("_first", "_surname")).drop("_branch", "_first", "_surname")
    m = machines.select("ref_no", F.col("branch").alias("m_branch"), F.col("machine_type").alias("m_type"), F.lit(True).alias("m_found"))
    et = F.broadcast(event_types.select(F.col("raw_label").alias("_type_key"), "code"))  # fixed 8 rows
    d = d.join(m, "ref_no", "left").join(et, F.lower(d.type_raw) == et._type_key, "left").drop("_type_key")

    edate = F.to_date("event_time")
    reason0 = (
        F.when(F.col("is_header"), "repeated_header_row")
        .when(F.col("n_got") != F.col("n_cols"), "wrong_column_count")
        .when(
            (F.col("ref_no") == "") | (F.col("type_raw") == "") | (F.col("time_raw") == "") | (F.col("rh_raw") == ""),
            "missing_required_value",
        )
        .when(F.col("event_time").isNull(), "invalid_timestamp")
        .when(F.col("delivery_date").isNotNull() & (edate >= F.col("delivery_date")), "timestamp_after_file_delivery")
        .when(F.col("m_found").isNull(), "machine_not_in_machine_list")
        .when(F.col("code").isNull(), "unknown_event_type")
        .when(F.col("rh_value").isNull(), "invalid_run_hours")
    )
    detail0 = (
        F.when(F.col("_r0") == "wrong_column_count", F.format_string("expected %d, got %d", F.col("n_cols"), F.col("n_got")))
        .when(F.col("_r0") == "invalid_timestamp", F.col("time_raw"))
        .when(F.col("_r0") == "timestamp_after_file_delivery", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("_r0") == "machine_not_in_machine_list", F.col("ref_no"))
        .when(F.col("_r0") == "unknown_event_type", F.col("type_raw"))
        .when(F.col("_r0") == "invalid_run_hours", F.col("rh_raw"))
    )
    d = d.withColumn("_r0", reason0).withColumn("_d0", detail0)
    if cut is not None:
        d = cut(d)

    # The first line of each (file, ref, time, type, run hours) key among rows that passed
    key = ["file_name", "ref_no", "event_time", "code", "rh_value"]
    passed = d.where(F.col("_r0").isNull())
    firsts = passed.groupBy(*key).agg(F.min("line_no").alias("_first_line"))
    # rejected lines take no part in the join
    d = passed.join(firsts, key).unionByName(d.where(F.col("_r0").isNotNull()).withColumn("_first_line", F.lit(None).cast("bigint")))
    is_dup = F.col("_r0").isNull() & (F.col("line_no") > F.col("_first_line"))
    d = d.withColumn("reason", F.when(is_dup, F.lit("duplicate_row_in_file")).otherwise(F.col("_r0"))).withColumn(
        "detail", F.when(is_dup, F.lit(None).cast("string")).otherwise(F.col("_d0"))
    )
    reported = F.coalesce(F.col("branch_norm"), F.col("m_branch"))
    d = d.withColumn("reported_branch", reported).withColumn(
        "is_late_arrival", F.coalesce(F.col("data_date").isNotNull() & (edate < F.col("data_date")), F.lit(False))
    ).withColumn("branch_mismatch", ~reported.eqNullSafe(F.col("m_branch")))
    classified = d.select(
        "file_name", "delivery_date", "data_date", "line_no", "raw_line", "reason", "detail",
        "ref_no", "event_time", "code", "rh_value", "reported_branch", "driver",
        "is_late_arrival", "branch_mismatch", "m_type",
    )
    return Cleaned(classified=classified, headers=ok, failures=failures)


def clean_summary(c: Cleaned) -> DataFrame:
    """Per-file counts; files with a header but no data rows get zeros."""
    cl = c.classified
    per_file = cl.groupBy("file_name").agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("reason").isNull()).alias("rows_clean"),
        F.count_if(F.col("reason").isNotNull()).alias("rows_rejected"),
        F.count_if(F.col("reason").isNull() & F.col("is_late_arrival")).alias("late_arrival_rows"),
        F.count_if(F.col("reason").isNull() & F.col("branch_mismatch")).alias("branch_mismatch_rows"),
    )
    by_reason = (
        cl.where(F.col("reason").isNotNull())
        .groupBy("file_name", "reason")
        .count()
        .groupBy("file_name")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "count")))).alias("rejected_by_reason"))
    )
    files = c.headers.select("file_name")
    out = files.join(per_file, "file_name", "left").join(by_reason, "file_name", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "file_name",
        F.coalesce("rows_read", zero).alias("rows_read"),
        F.coalesce("rows_clean", zero).alias("rows_clean"),
        F.coalesce("rows_rejected", zero).alias("rows_rejected"),
        F.coalesce("rejected_by_reason", F.create_map().cast("map<string,bigint>")).alias("rejected_by_reason"),
        F.coalesce("late_arrival_rows", zero).alias("late_arrival_rows"),
        F.coalesce("branch_mismatch_rows", zero).alias("branch_mismatch_rows"),
    )
