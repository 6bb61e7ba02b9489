"""Key filters: never miss a stored key, and loads read only the dates that a filter names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hourmeter.operators import keyfilter as KF
from hourmeter.plans import load as L
from hourmeter.plans.load import run_ingest
from hourmeter.plans.store import Store
from tests.helpers import HDR, MACHINES_CSV, PREFIX

KEYS = ["d", "k"]


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "d string, k long").repartition(3)


def test_filters_hold_every_key_and_few_others(spark):
    rnd = random.Random(1)
    held = [("a", k) for k in rnd.sample(range(10**9), 9000)] + [("b", k) for k in range(5)]
    more = [("a", -k) for k in range(1, 300)]  # a second load of the day, of another level
    filters = KF.build_filters(keyed(spark, held), "d", KEYS).unionByName(KF.build_filters(keyed(spark, more), "d", KEYS)).checkpoint()
    assert {r["level"] for r in filters.where("d = 'a'").collect()} == {1, 8}
    asked = held[::3] + held[-5:] + more + [("a", k + 10**10) for k in range(4000)] + [("c", 1)]
    got = {tuple(r) for r in KF.may_be_stored(keyed(spark, asked), filters, "d", KEYS).collect()}
    known = set(held) | set(more)
    assert known & set(asked) <= got
    assert len(got - known) < 0.02 * 4000 and ("c", 1) not in got


def test_merged_filters_are_the_filters_of_all_rows(spark):
    rows = [("a", k) for k in range(600)]
    whole = KF.build_filters(keyed(spark, rows), "d", KEYS)
    parts = KF.build_filters(keyed(spark, rows[:300]), "d", KEYS).unionByName(KF.build_filters(keyed(spark, rows[300:]), "d", KEYS))
    assert [tuple(r) for r in KF.merged(parts, "d").collect()] == [tuple(r) for r in KF.merged(whole, "d").collect()]


FILES = {f"2026-09-{d:02d}_DailyTelemetryData.csv": d for d in (8, 9, 10)}


def text(day, minutes):
    return "\n".join([HDR, *(f"2026-09-{day - 1:02d}T05:{m:02d}:00,QX70,Acme Millpond,Impact,{600 + m},LENA,VOS" for m in minutes)]) + "\n"


@pytest.mark.parametrize("keys_per_bucket", [KF.KEYS_PER_BUCKET, 10**9])
def test_loads_with_filters_insert_as_without(spark, write_files, tmp_path, monkeypatch, keys_per_bucket):
    """Also with one overfull bucket a day, of which every bit is set."""
    monkeypatch.setattr(KF, "KEYS_PER_BUCKET", keys_per_bucket)
    if keys_per_bucket > KF.BITS:
        monkeypatch.setattr(KF, "_bit", lambda second, i: F.lit(i).cast("long"))  # every key has the same bits: all are false positives
    ml = write_files({"machine_list.csv": MACHINES_CSV}, sub="ml") + "/machine_list.csv"
    inc = write_files({n: text(d, range(10)) for n, d in FILES.items()})
    with_filters, without = Store(spark, str(tmp_path / "a"), PREFIX), Store(spark, str(tmp_path / "b"), PREFIX)
    asked = []
    new_events = L.new_events

    def spied(existing, rows, branches, load_id, now, filters=None):
        seen = existing.where(F.lit(True))
        days = L._days
        monkeypatch.setattr(L, "_days", lambda df: asked.append(days(df)) or asked[-1])
        out = new_events(seen, rows, branches, load_id, now, filters).checkpoint()
        monkeypatch.setattr(L, "_days", days)
        return out

    for load in range(2):
        if load:  # the second delivery: one day again with a new row, one new day, one day late rows of another
            write_files({"2026-09-09_DailyTelemetryData.csv": text(9, range(12)), "2026-09-11_DailyTelemetryData.csv": text(11, range(4))})
            asked.clear()
        monkeypatch.setattr(L, "new_events", spied)
        run_ingest(spark, with_filters, inc, ml)
        monkeypatch.setattr(L, "new_events", lambda *a: new_events(*a[:5]))
        run_ingest(spark, without, inc, ml)
    got, want = ({tuple(r) for r in s.tables().events.select("event_time", "run_hours_seconds", "file_name").collect()} for s in (with_filters, without))
    assert got == want and len(got) == 36
    # the batch has two days, of which only the one delivered before is read
    assert [len(x) for x in asked] == [2, 1]


def test_a_warehouse_from_before_the_filters_reads_all_dates(spark, write_files, tmp_path):
    ml = write_files({"machine_list.csv": MACHINES_CSV}, sub="ml") + "/machine_list.csv"
    inc = write_files({n: text(d, range(3)) for n, d in FILES.items()})
    store = Store(spark, str(tmp_path / "old"), PREFIX)
    run_ingest(spark, store, inc, ml)
    fs, p = store._jvm_fs(store.path("event_filters"))
    fs.delete(p, True)
    assert store.tables().event_filters is None
    again = run_ingest(spark, store, inc, ml, reprocess_all=True)
    assert {r["rows_loaded"] for r in again.summary.collect()} == {0} and store.tables().event_filters is None


def test_the_scan_of_stored_events_names_the_asked_dates_only(spark, write_files, tmp_path):
    ml = write_files({"machine_list.csv": MACHINES_CSV}, sub="ml") + "/machine_list.csv"
    inc = write_files({n: text(d, range(5)) for n, d in FILES.items()})
    store = Store(spark, str(tmp_path / "w"), PREFIX)
    run_ingest(spark, store, inc, ml)
    t = store.tables()
    rows = spark.createDataFrame([("QX70", "2026-09-07 05:01:00", 601), ("QX70", "2026-09-20 05:01:00", 601)], "ref_no string, event_time string, run_hours_seconds long").select(
        "ref_no", F.to_timestamp_ntz("event_time").alias("event_time"), F.lit("IMPACT").alias("event_type"), "run_hours_seconds", F.lit("Millpond").alias("reported_branch"),
        F.struct(F.lit("x").alias("driver_key")).alias("driver"), F.lit("f").alias("file_name"), F.lit(1).alias("source_line"), F.lit(False).alias("is_late_arrival"), F.lit(False).alias("branch_mismatch"),
    )
    out = L.new_events(t.events, rows, t.branches, "x", L._now(), t.event_filters)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan) if "event_date" in x]
    assert scans and all("2026-09-07" in x and "2026-09-20" not in x for x in scans)
    assert [str(r["event_time"]) for r in out.collect()] == ["2026-09-20 05:01:00"]
