"""Splicing of late readings, and the operators that cut a hot key's time."""

import datetime as dt
import random

from pyspark.sql import functions as F

from hourmeter.operators import intervals as IV
from hourmeter.operators import periods as PD
from hourmeter.operators import quality as QL
from hourmeter.operators import views as V
from hourmeter.plans import contract as C
from hourmeter.plans import store as ST
from hourmeter.plans.store import Store, materialize

SF = "/root/testdata/sf0.001"


def test_late_readings_are_spliced_into_the_stored_rollups(spark, tmp_path, monkeypatch):
    t = C.facade_tables(spark, SF)
    events = t.events.checkpoint()
    late = (F.day("event_date") == 9) & (F.pmod("source_line", F.lit(5)) == 0) | (F.day("event_date") == 20)
    store = Store(spark, str(tmp_path / "w"))
    materialize(store, t.with_(events=events.where(~late)), load_id="first")
    held = store.tables()
    read = []
    monkeypatch.setattr(IV, "run_intervals", lambda e, f=IV.run_intervals: read.append(e.count()) or f(e))
    new = events.where(late).checkpoint()
    stamped = new.withColumn("loaded_at", F.current_timestamp()).withColumn("load_id", F.lit("second"))
    store.append("events", stamped, ["event_date"])
    ST.write_rollup(store, held.events, new, "second", held=held)
    sf = held.source_files.withColumn("load_ids", F.concat("load_ids", F.array(F.lit("second"))))
    store.commit(held.extra["manifest"], {"source_files": store.write_version("source_files", sf)})
    monkeypatch.undo()
    got = store.tables()
    whole = got.with_(interval_days=None, event_days=None)
    for f in (IV.machine_daily_hours, IV.driver_daily_hours, V.event_counts, V.data_coverage):
        assert sorted(map(str, f(got).collect())) == sorted(map(str, f(whole).collect()))
    touched = events.where(F.day("event_date").isin(9, 20)).join(new.select("event_date", "ref_no").distinct(), ["event_date", "ref_no"], "left_semi").count()
    assert read == [touched] and touched < events.where(F.day("event_date").isin(9, 20)).count()


def readings(spark, rows):
    return spark.createDataFrame(rows, "ref_no string, event_time timestamp, run_hours_seconds long, event_type string, file_name string, source_line long").select(
        "ref_no", F.col("event_time").cast("timestamp_ntz").alias("event_time"), F.to_date("event_time").alias("event_date"), "event_type", "run_hours_seconds",
        F.lit("d").alias("driver_key"), F.lit(1).alias("event_branch_id"), "file_name", "source_line",
    )


def test_reconcile_of_a_machine_with_many_readings_at_one_instant(spark):
    rnd = random.Random(3)
    day, rows = dt.datetime(2024, 5, 1), []
    for k in range(6000):  # one hour, many readings a second, counters that fall now and then
        at = day + dt.timedelta(hours=7, seconds=rnd.choice([0, 0, 1, 2, 900, 3599]))
        rows.append(("HOT", at, rnd.randint(0, 40), rnd.choice("ab"), "f", k))
    for k in range(300):
        rows.append((f"M{k % 4}", day + dt.timedelta(seconds=rnd.randint(0, 86_399)), rnd.randint(0, 4000), "a", "f", 10_000 + k))
    events = readings(spark, rows).checkpoint()
    daily = IV.interval_rollup(IV.run_intervals(events)).groupBy("event_date", "ref_no").agg(*[F.sum(c).alias(c) for c in ("run_seconds", "counter_resets", "capped_intervals")])
    t = C.facade_tables(spark, SF).with_(events=events)
    assert QL.reconcile_run_hours(t, daily=daily).collect() == []
    wrong = daily.withColumn("run_seconds", F.col("run_seconds") + F.when(F.col("ref_no") == "HOT", 1).otherwise(0))
    assert [r["ref_no"] for r in QL.reconcile_run_hours(t, daily=wrong).collect()] == ["HOT"]


def test_burst_windows_over_blocks_of_any_length(spark, monkeypatch):
    rnd = random.Random(8)
    at = dt.datetime(2024, 1, 1, 23, 50)
    rows = [(i, rnd.choice("xy"), at + dt.timedelta(seconds=rnd.choice([rnd.randint(0, 400), rnd.randint(0, 40_000)]), microseconds=rnd.choice([0, 0, 5, 999_999]))) for i in range(700)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp").repartition(3)
    for block, window in ((1, 60), (7, 60), (3600, 60), (3600, 5000), (50, 1)):
        monkeypatch.setattr(PD, "BLOCK_SECONDS", block)
        got = {r["id"]: r["hits_in_window"] for r in PD.burst_flag(df, "k", "t", limit=3, window_seconds=window).collect()}
        length = dt.timedelta(seconds=window)
        assert got == {i: sum(k2 == k and dt.timedelta(0) <= t - t2 < length for _, k2, t2 in rows) for i, k, t in rows}


def test_no_window_holds_a_key_s_whole_history(spark):
    df = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("t"))
    out = PD.burst_flag(df, "k", "t", limit=3)
    assert out.count() == 1_000_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("_block" in x or "_s#" in x.split("windowspecdefinition(")[1].split("ASC")[0] for x in windows)
