"""Cleaned-file JSON documents -> event, rejected, machine and file rows.

A document is ``{file, rows[], rejected[], summary, machines[], run}`` as produced
by a per-file cleaner elsewhere (e.g. posted to an endpoint and landed as JSON
lines).  Each document is parsed with a fixed schema (no inference) and its
arrays are exploded with ``inline_outer``; a missing array yields no rows and a
null ``driver`` stays null.

``payload_documents`` is the writing side: cleaned rows and rejected lines
become documents of the same shape, each holding one block of at most
``block_lines`` consecutive lines of one file, so no document grows with the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = """
struct<
  file: struct<file_name: string, delivery_date: string, data_date: string, checksum: string>,
  rows: array<struct<ref_no: string, event_time: string, event_type: string, run_hours_seconds: bigint,
                     reported_branch: string,
                     driver: struct<first_name: string, surname: string, driver_key: string>,
                     source_line: bigint, is_late_arrival: boolean, branch_mismatch: boolean>>,
  rejected: array<struct<line_no: bigint, raw_line: string, reason: string, detail: string>>,
  summary: struct<rows_read: bigint, rows_clean: bigint, rows_rejected: bigint,
                  rejected_by_reason: map<string, bigint>, late_arrival_rows: bigint, branch_mismatch_rows: bigint>,
  machines: array<struct<ref_no: string, branch: string, machine_type: string>>,
  run: struct<started_at: string, triggered_by: string>,
  broken: string
>
"""


@dataclass
class Payload:
    files: DataFrame
    rows: DataFrame
    rejected: DataFrame
    machines: DataFrame
    failures: DataFrame  # (value, error): documents that are not JSON of this shape, or name no file


def explode_payload(docs: DataFrame, col: str = "value") -> Payload:
    parsed = docs.select(
        F.col(col).alias("value"), F.from_json(F.col(col), PAYLOAD_SCHEMA, {"columnNameOfCorruptRecord": "broken"}).alias("p")
    )
    error = (
        F.when(F.col("p").isNull() | F.col("p.broken").isNotNull(), F.lit("not a document of cleaned rows"))
        .when(F.coalesce(F.col("p.file.file_name"), F.lit("")) == "", F.lit("document names no file"))
    )
    parsed = parsed.withColumn("error", error)
    failures = parsed.where(F.col("error").isNotNull()).select("value", "error")
    p = parsed.where(F.col("error").isNull()).select("p")
    files = p.select(
        F.col("p.file.file_name").alias("file_name"),
        F.to_date(F.nullif(F.col("p.file.delivery_date"), F.lit(""))).alias("delivery_date"),
        F.to_date(F.nullif(F.col("p.file.data_date"), F.lit(""))).alias("data_date"),
        F.col("p.file.checksum").alias("checksum"),
        F.col("p.summary.*"),
        F.col("p.run.started_at").cast("timestamp").alias("started_at"),
        F.coalesce(F.col("p.run.triggered_by"), F.lit("schedule")).alias("triggered_by"),
    )
    base = p.select(F.col("p.file.file_name").alias("file_name"), "p.rows", "p.rejected", "p.machines")
    rows = base.select("file_name", F.inline_outer(F.coalesce("rows", F.array().cast(base.schema["rows"].dataType)))).where(
        F.col("ref_no").isNotNull()
    )
    rows = rows.withColumn("event_time", F.col("event_time").try_cast("timestamp_ntz")).withColumn(
        "is_late_arrival", F.coalesce("is_late_arrival", F.lit(False))
    ).withColumn("branch_mismatch", F.coalesce("branch_mismatch", F.lit(False)))
    rejected = base.select(
        "file_name", F.inline_outer(F.coalesce("rejected", F.array().cast(base.schema["rejected"].dataType)))
    ).where(F.col("line_no").isNotNull())
    machines = base.select(F.inline_outer(F.coalesce("machines", F.array().cast(base.schema["machines"].dataType)))).where(
        F.col("ref_no").isNotNull()
    )
    return Payload(files=files, rows=rows, rejected=rejected, machines=machines.distinct(), failures=failures)


PAYLOAD_BLOCK_LINES = 1000


def payload_documents(rows: DataFrame, rejected: DataFrame, block_lines: int = PAYLOAD_BLOCK_LINES) -> DataFrame:
    """Cleaned rows + rejected lines -> one JSON document (``value``) per (file, block of lines)."""
    r = rows.select(
        "file_name",
        F.floor(F.col("source_line") / block_lines).alias("block"),
        "delivery_date",
        "data_date",
        F.struct(
            F.col("source_line").cast("bigint").alias("source_line"),
            "ref_no",
            F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"),
            "event_type",
            "run_hours_seconds",
            "reported_branch",
            "driver",
            "is_late_arrival",
            "branch_mismatch",
        ).alias("r"),
    )
    x = rejected.select(
        "file_name",
        F.floor(F.col("line_no") / block_lines).alias("block"),
        F.struct(F.col("line_no").cast("bigint").alias("line_no"), "raw_line", "reason", "detail").alias("x"),
    )
    rg = r.groupBy("file_name", "block").agg(
        F.array_sort(F.collect_list("r")).alias("rows"),
        F.min("delivery_date").alias("delivery_date"),
        F.min("data_date").alias("data_date"),
    )
    xg = x.groupBy("file_name", "block").agg(F.array_sort(F.collect_list("x")).alias("rejected"))
    docs = rg.join(xg, ["file_name", "block"], "full")
    file = F.struct(
        "file_name",
        F.date_format("delivery_date", "yyyy-MM-dd").alias("delivery_date"),
        F.date_format("data_date", "yyyy-MM-dd").alias("data_date"),
        F.lit(None).cast("string").alias("checksum"),
    )
    return docs.select(F.to_json(F.struct(file.alias("file"), "rows", "rejected")).alias("value"))
