"""A feed of readings, shuffled, repeated and late, ends in the events of one batch load."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourmeter.plans import contract as C
from hourmeter.plans.load import load_feed
from hourmeter.plans.store import Store, materialize
from hourmeter.streaming.readings import READING, stream_readings


def warehouse(spark, root):
    """Machines M1 and M2 at two branches, and no event."""
    t = C.facade_tables(spark, "/root/testdata/sf0.001")
    branches = spark.createDataFrame([(1, "Millpond"), (2, "Quayside")], "branch_id int, name string")
    machines = spark.createDataFrame([("M1", 1, "PPT"), ("M2", 2, "Forklift")], "ref_no string, home_branch_id int, machine_type string")
    store = Store(spark, root)
    materialize(store, t.with_(branches=branches, machines=machines, drivers=t.drivers.limit(0), events=t.events.limit(0), source_files=t.source_files.limit(0)), load_id="start")
    return store


def events_of(store):
    return sorted(tuple(r) for r in store.tables().events.select("ref_no", "event_time", "event_type", "run_hours_seconds").collect())


@pytest.fixture(scope="module")
def readings():
    rnd = random.Random(6)
    at = dt.datetime(2024, 3, 1, 8)
    rows = [(rnd.choice(["M1", "M2"]), at + dt.timedelta(minutes=rnd.randint(0, 3000)), rnd.choice(["IMPACT", "HEARTBEAT"]), rnd.randint(0, 500), rnd.choice([None, "Millpond"]), "Lena", "Vos") for _ in range(60)]
    rows += [("GHOST", at, "IMPACT", 5, None, None, None), ("M1", None, "IMPACT", 5, None, None, None), (None, at, "IMPACT", 5, None, None, None), ("M1", at, "DANCE", 5, None, None, None), ("M1", at, "IMPACT", -1, None, None, None)]
    return rows


def test_a_shuffled_and_repeated_feed_ends_in_one_loads_events(spark, tmp_path, readings):
    rnd = random.Random(1)
    batches = [[] for _ in range(3)]
    for seq, row in enumerate(readings):
        for k in rnd.sample(range(3), rnd.choice([1, 2, 3])):  # the same reading in several micro-batches, and twice in one
            batches[k] += [(*row, seq)] * rnd.choice([1, 2])
    folder = str(tmp_path / "feed")
    for rows in batches:
        rnd.shuffle(rows)
        spark.createDataFrame(rows, READING).coalesce(1).write.mode("append").parquet(folder)
    store = warehouse(spark, str(tmp_path / "streamed"))
    feed = spark.readStream.schema(READING).option("maxFilesPerTrigger", "1").parquet(folder)
    q = stream_readings(spark, store, feed, "feed", str(tmp_path / "ckpt"))
    q.awaitTermination()
    assert len(q.recentProgress) >= 3
    # repeats went in the stream: what reached the sink is every key once
    log = store.read("ingestion_runs").where("triggered_by = 'stream'").agg(F.sum("rows_read"), F.sum("rows_already_loaded"), F.sum("rows_rejected")).first()
    assert tuple(log) == (len(set(r[:4] for r in readings)), 0, 5)

    whole = warehouse(spark, str(tmp_path / "whole"))
    load_feed(spark, whole, spark.createDataFrame([(*r, i) for i, r in enumerate(readings)], READING), "all")
    assert events_of(store) == events_of(whole) and len(events_of(store)) == len({r[:4] for r in readings[:60]})
    reasons = {r["reason"] for r in store.tables().rejected_rows.collect()}
    assert reasons == {"machine_not_in_machine_list", "invalid_timestamp", "missing_required_value", "unknown_event_type", "invalid_run_hours"}

    # a batch that runs again does nothing, and a reading whose state is gone is caught by the sink
    n = len(events_of(store))
    load_feed(spark, store, spark.createDataFrame([(*readings[0], 0)], READING), "feed-000000000")
    load_feed(spark, store, spark.createDataFrame([(*r, 0) for r in readings[:20]], READING), "much-later")
    assert len(events_of(store)) == n
    assert store.read("ingestion_runs").where("file_name = 'much-later'").first()["rows_already_loaded"] == len({r[:4] for r in readings[:20]})
