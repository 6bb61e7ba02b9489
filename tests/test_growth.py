"""Steps whose work must not grow faster than their input, told from plans and files."""

import os

from pyspark.sql import functions as F

from hourmeter.model import event_types_df
from hourmeter.operators import cleaning as CL
from hourmeter.operators.keyfilter import build_filters
from hourmeter.plans.load import insert_drivers
from hourmeter.plans.store import Store
from hourmeter.sources.drift import explode_drifting


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_are_not_dealt_by_file(spark):
    lines = [(f"2026-09-0{d}_DailyTelemetryData.csv", n, f"row {n}", ["a", str(n)]) for d in (1, 2) for n in (1, 2, 3)]
    records = spark.createDataFrame(lines, "file_name string, line_no bigint, raw_line string, fields array<string>")
    machines = spark.createDataFrame([("FBA1", "Harbour", "Forklift")], "ref_no string, branch string, machine_type string")
    seen = []

    def cut(df):
        seen.append(df)
        return df

    CL.clean_records(records, machines, event_types_df(spark), cut=cut)
    assert "SortMergeJoin [file_name" not in _plan(seen[1])


def test_filter_keys_meet_before_they_become_bits(spark):
    rows = spark.range(5000).select(F.date_add(F.lit("2026-09-01").cast("date"), (F.col("id") % 2).cast("int")).alias("event_date"), "id")
    text = _plan(build_filters(rows, "event_date", ["event_date", "id"]))
    # from the result down: no exchange lies between the two halves of the bitmap aggregate
    halves = text.split("bitmap_construct_agg")
    assert len(halves) > 2
    assert "Exchange" not in halves[1]


def test_append_writes_few_files_a_day(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    days = spark.range(400).select(
        F.date_add(F.lit("2026-09-01").cast("date"), (F.col("id") % 4).cast("int")).alias("event_date"),
        F.lit(1).alias("level"), F.lit(0).alias("bucket"), F.lit(b"x").cast("binary").alias("bits"), F.lit("l").alias("filter_load_id"),
    )
    store.append("event_filters", days.repartition(8), partition_by=["event_date"])
    files = [f for _, _, names in os.walk(tmp_path / "w") for f in names if f.endswith(".parquet")]
    assert len(files) == 4
    assert store.read("event_filters").count() == 400


def test_first_spelling_of_a_driver_wins(spark):
    rows = [("a", 2, "ANN", "LEE"), ("a", 1, "Ann", "Lee"), ("b", 0, "ann", "lee"), ("a", 3, "Ann", "Lee")]
    rows = spark.createDataFrame(rows, "file_name string, source_line bigint, f string, s string").select(
        "file_name", "source_line", F.struct(F.col("f").alias("first_name"), F.col("s").alias("surname"), F.lit("ann lee").alias("driver_key")).alias("driver")
    )
    none = spark.createDataFrame([], "driver_key string, first_name string, surname string, display_name string")
    df = insert_drivers(none, rows)
    assert [tuple(r) for r in df.collect()] == [("ann lee", "Ann", "Lee", "Ann Lee")]
    assert "partial_min(source_line" in _plan(df)  # a hash aggregate before the struct's sorted one


def test_drift_judges_documents_in_one_pass(spark):
    docs = spark.createDataFrame([('{"file": {"file_name": "f"}, "rows": [{"ref_no": "R", "x": 1}, 7], "rejected": 5, "new": true}',)], "value string")
    cuts = []

    def cut(df):
        cuts.append(df)
        return df.checkpoint()

    drift = explode_drifting(docs, cut=cut).drift
    assert len(cuts) == 1
    assert _plan(drift).count("Scan ExistingRDD") == 1
    got = sorted((r.section, r.place, r.field, r.kind, r.value, r.element) for r in drift.collect())
    assert [g[:5] for g in got] == [
        ("document", -1, "new", "extra", "true"),
        ("document", -1, "rejected", "mistyped", "5"),
        ("rows", 0, "x", "extra", "1"),
        ("rows", 1, "", "mistyped", "7"),
    ]
    assert [g[5] is None for g in got] == [True, True, False, False]
