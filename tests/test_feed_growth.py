"""a feed of readings is written, taken and loaded by as many tasks as its rows need."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hourmeter.plans import contract_more as M
from hourmeter.plans import load as L
from hourmeter.plans.load import load_feed
from hourmeter.streaming import readings as R
from hourmeter.streaming.readings import READING, stream_readings
from tests.test_readings_stream import warehouse

AT = dt.datetime(2024, 3, 1, 8)
ROWS = [("M1", AT + dt.timedelta(minutes=k), "IMPACT", k, "Millpond", "Lena", "Vos", k) for k in range(20)]


def test_a_micro_batch_is_loaded_with_the_callers_adaptive_plans(spark, tmp_path, monkeypatch):
    spark.createDataFrame(ROWS, READING).coalesce(1).write.parquet(str(tmp_path / "feed"))
    setting, seen = "spark.sql.adaptive.enabled", []
    monkeypatch.setattr(R, "load_feed", lambda spark, store, batch, name: seen.append((batch.sparkSession, batch.sparkSession.conf.get(setting), batch.count())))
    feed = spark.readStream.schema(READING).parquet(str(tmp_path / "feed"))
    stream_readings(spark, None, feed, "feed", str(tmp_path / "ckpt")).awaitTermination()
    assert seen[0][1:] == (spark.conf.get(setting), len(ROWS)) and spark.conf.get(setting) == "true"
    assert seen[0][0].conf.get(setting) == "false"  # the stream's own plans are as they were


def test_a_delivery_has_files_by_its_rows_and_is_one_micro_batch(spark, monkeypatch):
    monkeypatch.setattr(M, "FEED_FILE_ROWS", 300)
    got = []

    class Taken(Exception):
        pass

    def taken(spark, store, stream, name, checkpoint):
        root = checkpoint.rpartition("/")[0]
        stream.writeStream.foreachBatch(lambda b, k: got.append(b.select("ref_no", "seq").collect())).option("checkpointLocation", root + "/taken").trigger(availableNow=True).start().awaitTermination()
        got.append([f for f in os.listdir(root.removeprefix("file:") + "/feed") if f.endswith(".parquet")])
        raise Taken

    monkeypatch.setattr(M, "stream_readings", taken)
    with pytest.raises(Taken):
        M._feed_state(spark, "/root/testdata/sf0.001")
    *batches, files = got
    events = M.facade_tables(spark, "/root/testdata/sf0.001").events
    place = F.pmod(F.xxhash64("ref_no", "source_line"), F.lit(3))
    want = [set(), set(), set()]
    for ref, line, k in events.select("ref_no", "source_line", place).collect():
        for j in (k, (k + 1) % 3)[: 2 if line % 3 else 1]:
            want[j].add((ref, line))
    assert [set(map(tuple, b)) for b in batches] == want and [len(b) for b in batches] == list(map(len, want))
    assert len(files) == 3 * -(-events.count() // 300) > 3


def test_rows_of_few_branches_are_not_dealt_by_branch(spark, tmp_path, monkeypatch):
    store = warehouse(spark, str(tmp_path / "w"))
    t = store.tables()
    branches = L.insert_branches(t.branches, spark.createDataFrame([("Millpond",)], "name string")).checkpoint()
    # two rows of a key at one place both stay, later copies go
    lines = [(f"M{k % 2}", AT, "IMPACT", 5, "Millpond", "f", n) for k in range(2) for n in (3, 2, 2)] + [(None, AT, "IMPACT", 5, "Millpond", "f", 9)]
    rows = spark.createDataFrame(lines, "ref_no string, event_time timestamp_ntz, event_type string, run_hours_seconds bigint, reported_branch string, file_name string, source_line bigint").withColumns(
        {"driver": F.struct(F.lit("d").alias("driver_key")), "is_late_arrival": F.lit(False), "branch_mismatch": F.lit(False)}
    ).checkpoint()
    plans = []
    kind = type(rows)
    checkpoint = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or checkpoint(df, *a))
    new = L.new_events(t.events, rows, branches, "x", L._now(), t.event_filters)
    assert "BroadcastHashJoin [reported_branch" in plans[0] and "hashpartitioning(reported_branch" not in plans[0]
    assert plans[0].count("hashpartitioning(event_date") == 1  # the rows meet by their key once
    assert sorted((r["ref_no"], r["source_line"]) for r in new.collect()) == [("M0", 2), ("M0", 2), ("M1", 2), ("M1", 2)]


def test_only_rejected_readings_are_kept_as_text_and_an_empty_batch_rewrites_nothing(spark, tmp_path, monkeypatch):
    store = warehouse(spark, str(tmp_path / "w"))
    texts, new_events = [], L.new_events
    monkeypatch.setattr(L, "new_events", lambda existing, rows, *a: texts.append(rows.where("raw_line is not null").count()) or new_events(existing, rows, *a))
    load_feed(spark, store, spark.createDataFrame([*ROWS, ("GHOST", AT, "IMPACT", 5, None, None, None, 99)], READING), "first")
    assert texts == [0] and store.tables().events.count() == len(ROWS)
    rejected = store.tables().rejected_rows.collect()
    assert len(rejected) == 1 and '"ref_no":"GHOST"' in rejected[0]["raw_line"] and rejected[0]["line_no"] == 99
    held = store.manifest()[1]
    load_feed(spark, store, spark.createDataFrame([], READING), "empty")
    now = store.manifest()[1]
    assert {k for k in now if now[k] != held[k]} == {"source_files"}
    assert store.read("source_files").where("file_name = 'empty'").count() == 1
    log = store.read("ingestion_runs").where("file_name = 'empty'").first()
    assert (log["status"], log["rows_read"], log["rows_loaded"], log["rows_rejected"]) == ("success", 0, 0, 0)
