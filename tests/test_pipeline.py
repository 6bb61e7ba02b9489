"""End-to-end on a tiny drop folder: stream ingest, views, dashboard, replay, payloads, report."""

import json

import pytest
from pyspark.sql import functions as F

from hourmeter.operators import intervals as IV
from hourmeter.operators import quality as QL
from hourmeter.operators import views as V
from hourmeter.plans import report as RP
from hourmeter.plans import snapshot as SN
from hourmeter.plans.store import Store
from hourmeter.plans.views import VIEW_NAMES, register_views
from hourmeter.sources.payload import explode_payload
from hourmeter.streaming.ingest import stream_ingest
from hourmeter.streaming.replay import replay_rejected
from tests.helpers import HDR, PREFIX

MACHINES = "RefNo.,BranchName,MachineType\nQX70,Millpond,Forklift\nT4 ,Quayside,PPT\n"
MACHINES_FIXED = MACHINES + "W5,Hillside,Reach Truck\n"
DAY1 = "\n".join(
    [
        HDR,
        # steps of QX70: +900 in 1200 s, a reset, +600 in 600 s, +5000 in 900 s (capped to 900)
        "2026-09-07T13:00:00,QX70,Acme Millpond,Power Up,2000,Lena,Vos",
        "2026-09-07T13:20:00,QX70,Acme Millpond,Unit (Time/GPS) Update Level,2900,Lena,Vos",
        "2026-09-07T13:40:00,QX70,Acme Millpond,Impact,10,Lena,Vos",
        "2026-09-07T13:50:00,QX70,Acme Quayside,Speeding,610,,",
        "2026-09-07T14:05:00,QX70,Acme Quayside,Harsh Braking,5610,,",
        "2026-09-07T15:00:00,W5,Acme Hillside,Impact,30,Bo,Lund",
        "2026-09-07T15:10:00,W5,Acme Hillside,Impact,330,Bo,Lund",
        "2026-09-07T16:00:00,T4,Acme Quayside,Excess Idle,7,,",
    ]
) + "\n"
DAY2 = HDR + "\n2026-09-08T20:00:00,T4,Acme Quayside,Power Up,40,Bo,Lund\n2026-09-08T20:30:00,T4,Acme Quayside,Impact,1840,Bo,Lund\n"
F1 = "2026-09-08_DailyTelemetryData.csv"
F2 = "2026-09-09_DailyTelemetryData.csv"


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipe")
    inc = root / "incoming"
    inc.mkdir()
    (inc / F1).write_text(DAY1)
    (root / "ml").mkdir()
    ml = root / "ml" / "machine_list.csv"
    ml.write_text(MACHINES)
    store = Store(spark, str(root / "wh"), PREFIX)
    q = stream_ingest(spark, store, str(inc), str(ml), str(root / "ckpt"))
    q.awaitTermination(600)
    (inc / F2).write_text(DAY2)
    q = stream_ingest(spark, store, str(inc), str(ml), str(root / "ckpt"))
    q.awaitTermination(600)
    return store, str(ml), root


def test_stream_loaded_each_file_once(spark, loaded):
    store, _, _ = loaded
    runs = store.read("ingestion_runs").orderBy("file_name").collect()
    assert [(r["file_name"], r["status"], r["rows_loaded"], r["rows_rejected"]) for r in runs] == [
        (F1, "success", 6, 2),
        (F2, "success", 2, 0),
    ]


def test_run_hours_reset_and_cap(spark, loaded):
    store, _, _ = loaded
    t = store.tables()
    d = {(r["ref_no"], str(r["event_date"])): r for r in IV.machine_daily_hours(t).collect()}
    qx = d[("QX70", "2026-09-07")]
    assert (qx["run_seconds"], qx["counter_resets"], qx["capped_intervals"]) == (2400, 1, 1)
    assert qx["run_hours"] == 0.67 and qx["operating_branch"] == "Millpond"  # 2-2 tie: lowest branch id
    assert d[("T4", "2026-09-08")]["run_seconds"] == 1800
    assert ("T4", "2026-09-07") not in d  # a single reading has no interval
    assert QL.reconcile_run_hours(t).collect() == []  # the two methods agree, single readings included


def test_sql_views(spark, loaded):
    store, _, _ = loaded
    names = register_views(spark, store.tables())
    assert names == VIEW_NAMES
    r = spark.sql("select sum(run_seconds) s from v_machine_daily_hours").first()
    assert r["s"] == 2400 + 1800
    r = spark.sql("select driver_name, run_hours from v_driver_daily_hours where event_date = date'2026-09-07' order by 1").collect()
    assert [(x[0], x[1]) for x in r] == [("Lena Vos", 0.25), ("No driver logged on", 0.42)]


def test_dashboard_document(spark, loaded):
    store, _, _ = loaded
    snap = SN.dashboard_snapshot(store.tables())
    doc = json.loads(snap.to_json())
    snap.release()
    assert doc["period"] == {"from": "2026-09-07", "to": "2026-09-08"}
    k = doc["kpis"]
    assert k["total_machines"] == 2 and k["active_machines"] == 2 and k["active_drivers"] == 2
    assert k["safety_events"] == 5 and k["impacts"] == 2 and k["run_hours"] == 1.2
    assert [m["ref_no"] for m in doc["machine_hours"]][0] == "QX70"
    assert [d["driver_name"] for d in doc["top_drivers"]] == ["Bo Lund", "Lena Vos"]
    assert doc["data_quality"]["events_without_driver"] == 3
    assert [f["file_name"] for f in doc["data_quality"]["files"]] == [F1, F2]


def test_empty_period_gives_zeros(spark, loaded):
    store, _, _ = loaded
    snap = SN.dashboard_snapshot(store.tables(), "2030-01-01", "2030-01-02", cache=False)
    doc = json.loads(snap.to_json())
    assert doc["kpis"]["run_hours"] == 0.0 and doc["kpis"]["safety_events"] == 0
    assert doc["daily_hours_by_branch"] == [] and doc["top_drivers"] == []
    assert all(m["hours"] == 0.0 for m in doc["machine_hours"])


def test_replay_after_machine_list_fix(spark, loaded):
    store, ml, root = loaded
    t = store.tables()
    assert t.rejected_rows.where("reason = 'machine_not_in_machine_list'").count() == 2
    fixed = root / "ml" / "machine_list_fixed.csv"
    fixed.write_text(MACHINES_FIXED)
    out = replay_rejected(spark, store, str(fixed), "machine_not_in_machine_list").collect()
    assert [(r["file_name"], r["rows_replayed"], r["rows_loaded"]) for r in out] == [(F1, 2, 2)]
    assert store.tables().events.where("ref_no = 'W5'").count() == 2
    # a second replay finds the events already loaded
    out2 = replay_rejected(spark, store, str(fixed), "machine_not_in_machine_list").collect()
    assert out2[0]["rows_loaded"] == 0


def test_explode_payload(spark):
    doc = {
        "file": {"file_name": F1, "delivery_date": "2026-09-08", "data_date": "2026-09-07", "checksum": "abc"},
        "rows": [
            {"ref_no": "QX70", "event_time": "2026-09-07 06:00:00", "event_type": "IMPACT", "run_hours_seconds": 5,
             "reported_branch": "Millpond", "driver": None, "source_line": 2, "is_late_arrival": False, "branch_mismatch": False}
        ],
        "summary": {"rows_read": 1, "rows_clean": 1, "rows_rejected": 0, "rejected_by_reason": {}},
        "machines": [{"ref_no": "QX70", "branch": "Millpond", "machine_type": "Forklift"}],
        "run": {"started_at": "2026-09-08T04:00:00Z", "triggered_by": None},
    }
    df = spark.createDataFrame([(json.dumps(doc),), ("not json",), ("{bad json",)], "value string")
    p = explode_payload(df)
    assert p.rows.count() == 1 and p.rows.first()["driver"] is None
    assert p.rejected.count() == 0
    f = p.files.first()
    assert str(f["data_date"]) == "2026-09-07" and f["triggered_by"] == "schedule"
    assert p.files.count() == 1 and [r["value"] for r in p.failures.collect()] == ["not json", "{bad json"]


def test_clean_report(spark, loaded):
    _, ml, root = loaded
    rep = RP.clean_report(spark, str(root / "incoming"), ml, PREFIX)
    totals = {r["event_type"]: r["events"] for r in rep.totals_by_type.collect()}
    assert totals["IMPACT"] == 2 and sum(totals.values()) == 8
    flagged = rep.flagged_machine_days.collect()
    assert [(r["ref_no"], r["run_seconds"], r["counter_resets"], r["capped_intervals"]) for r in flagged] == [("QX70", 2400, 1, 1)]
    s = {r["file_name"]: r["rows_read"] for r in rep.summary.collect()}
    assert s == {F1: 8, F2: 2}


def test_stored_rollup_matches_events_and_ignores_uncommitted(spark, loaded):
    """After two stream loads and a replay, which touches an already loaded date."""
    from hourmeter.plans.store import write_rollup

    store, _, root = loaded
    fixed = root / "ml" / "machine_list_fixed.csv"
    fixed.write_text(MACHINES_FIXED)
    replay_rejected(spark, store, str(fixed), "machine_not_in_machine_list").collect()  # a no-op if already replayed
    t = store.tables()
    assert t.interval_days is not None and t.event_days is not None

    def e3(tt):
        return sorted(tuple(r) for r in V.event_counts(tt).collect())

    def e1(tt):
        return sorted(tuple(r) for r in IV.machine_daily_hours(tt).collect())

    def e2(tt):
        return sorted(tuple(r) for r in IV.driver_daily_hours(tt).collect())

    from_events = t.with_(interval_days=None, event_days=None)
    assert e1(t) == e1(from_events) and e2(t) == e2(from_events)
    assert e3(t) == e3(from_events) == sorted(tuple(r) for r in V.event_counts(t, V.v_events(t)).collect())
    for f in (V.available_days, V.data_coverage):
        assert sorted(tuple(r) for r in f(t).collect()) == sorted(tuple(r) for r in f(from_events).collect())
    assert any(r[2] == "W5" for r in e1(t))  # the replayed machine-day is in the stored rollup
    # a load that wrote its rollup and died before the commit: its rollup is never read
    fake = t.events.where(F.col("ref_no") == "QX70").withColumn("run_hours_seconds", F.col("run_hours_seconds") * 7)
    write_rollup(store, t.events.limit(0), fake, "died-before-commit")
    assert e1(store.tables()) == e1(from_events) and e3(store.tables()) == e3(from_events)
