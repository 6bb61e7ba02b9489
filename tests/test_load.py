import pytest
from pyspark.sql import functions as F

from hourmeter.plans import load as L
from hourmeter.plans.load import pipeline_runs, run_ingest
from hourmeter.plans.store import CommitConflict, Store, compact_rollups
from hourmeter.streaming.replay import replay_rejected
from tests.helpers import HDR, MACHINES_CSV, PREFIX

F1, F2, F3 = (f"2026-09-{d}_DailyTelemetryData.csv" for d in ("08", "09", "10"))
DAY1 = "\n".join(
    [
        HDR,
        "2026-09-07T05:10:00,QX70,Acme Millpond,Power Up,600,LENA,VOS",
        "2026-09-07T05:40:00,QX70,Acme Millpond,Harsh Braking,1500,LENA,VOS",
        "2026-09-07T05:40:00,QX70,Acme Millpond,Harsh Braking,1500,LENA,VOS",
        "2026-09-07T06:00:00,GHOST,Acme Millpond,Impact,9,Kim,Roe",
        "2026-09-07T06:30:00,T4,Acme Hillside,Excess Idle,70,,",
    ]
) + "\n"
DAY2 = "\n".join(
    [
        HDR,
        "2026-09-07T05:40:00,QX70,Acme Millpond,Harsh Braking,1500,Lena,Vos",  # a reading of the day before, again
        "2026-09-08T12:00:00,QX70,Acme Millpond,Impact,9000,lena,vos",
    ]
) + "\n"


@pytest.fixture()
def place(spark, write_files, tmp_path):
    """(write files into the drop folder, its path, machine list path, warehouse)."""

    def put(files):
        return write_files(files, sub="drop 50%25 #x")

    ml = write_files({"machine_list.csv": MACHINES_CSV}, sub="ml") + "/machine_list.csv"
    return put, put({}), ml, Store(spark, str(tmp_path / "wh"), PREFIX)


def by_file(run):
    return {r["file_name"]: r for r in run.summary.collect()}


def counts(r):
    return tuple(r[c] for c in ("rows_read", "rows_loaded", "rows_already_loaded", "rows_rejected"))


def test_load_reload_and_reprocess(spark, place):
    put, inc, ml, store = place
    put({F1: DAY1, F2: DAY2, F3: "", "notes.txt": "x"})
    first = run_ingest(spark, store, inc, ml, triggered_by="manual")
    s = by_file(first)
    assert {n: r["status"] for n, r in s.items()} == {F1: "success", F2: "success", F3: "failed"}
    assert (counts(s[F1]), counts(s[F2])) == ((5, 3, 0, 2), (2, 1, 1, 0))
    assert s[F3]["error_message"] == "File is empty"
    assert first.machines_changed == 2
    t = store.tables()
    assert (t.events.count(), t.rejected_rows.count()) == (4, 2)
    assert [tuple(r) for r in t.branches.orderBy("branch_id").collect()] == [(1, "Millpond"), (2, "Quayside"), (3, "Hillside")]
    assert [r["display_name"] for r in t.drivers.collect()] == ["Lena Vos"]
    assert t.events.where("event_type = 'HARSH_BRAKING'").first()["file_name"] == F1  # the first file that has it
    t4 = t.events.where("ref_no = 'T4'").first()
    assert t4["branch_mismatch"] and t4["driver_key"] is None

    # again: the loaded files are not even read, the failed one is tried again
    again = by_file(run_ingest(spark, store, inc, ml))
    assert set(again) == {F3} and store.tables().events.count() == 4
    runs = pipeline_runs(store).orderBy("started_at").collect()
    assert [(x["files_seen"], x["files_to_load"]) for x in runs] == [(3, 3), (3, 1)]

    # everything once more: all clean rows are loaded already
    third = run_ingest(spark, store, inc, ml, reprocess_all=True)
    assert counts(by_file(third)[F1]) == (5, 0, 3, 2) and third.machines_changed == 0
    reg = {x["file_name"]: x for x in store.tables().source_files.collect()}
    assert (reg[F1]["load_count"], str(reg[F1]["data_date"])) == (2, "2026-09-07") and F3 not in reg
    assert store.tables().events.count() == 4


def test_failed_file_is_retried_and_changed_file_reloads(spark, place):
    put, inc, ml, store = place
    put({F1: DAY1, F2: "When,Where\nnow,here\n"})
    s = by_file(run_ingest(spark, store, inc, ml))
    assert s[F2]["error_message"].startswith("Missing required column(s)") and s[F1]["status"] == "success"
    put({F2: DAY2})
    s = by_file(run_ingest(spark, store, inc, ml))
    assert set(s) == {F2} and s[F2]["rows_loaded"] == 1
    put({F1: DAY1 + "2026-09-07T07:45:00,QX70,Acme Millpond,Speeding,2222,,\n"})
    s = by_file(run_ingest(spark, store, inc, ml))
    assert set(s) == {F1} and counts(s[F1]) == (6, 1, 3, 2)
    # the date was rolled up again; compaction leaves one rollup a date and the same answers
    before = sorted(map(str, store.tables().interval_days.collect()))
    assert compact_rollups(store) > 0 and compact_rollups(store) == 0
    assert sorted(map(str, store.tables().interval_days.collect())) == before


def test_a_load_that_dies_leaves_nothing_visible(spark, place, write_files, monkeypatch):
    put, inc, ml, store = place
    put({F1: DAY1})
    run_ingest(spark, store, inc, ml)
    put({F2: DAY2})
    changed = write_files({"machine_list.csv": MACHINES_CSV.replace("QX70,Millpond,Forklift", "QX70,Millpond,PPT")}, sub="ml2") + "/machine_list.csv"

    def dies(*a):
        raise OSError("lost")

    monkeypatch.setattr(L, "register_files", dies)
    with pytest.raises(OSError):
        run_ingest(spark, store, inc, changed)
    monkeypatch.undo()
    t = store.tables()
    assert t.machines.where("ref_no = 'QX70'").first()["machine_type"] == "Forklift"
    assert t.events.count() == 3 and t.source_files.count() == 1
    run_ingest(spark, store, inc, changed)
    t = store.tables()
    assert t.machines.where("ref_no = 'QX70'").first()["machine_type"] == "PPT"
    assert t.events.count() == 4


def test_of_two_loads_at_once_one_is_rejected(spark, place, monkeypatch):
    put, inc, ml, store = place
    put({F1: DAY1})
    real, inner = L.register_files, []

    def second_load_inside(*a):
        if not inner:
            inner.append(True)
            run_ingest(spark, store, inc, ml)
        return real(*a)

    monkeypatch.setattr(L, "register_files", second_load_inside)
    with pytest.raises(CommitConflict):
        run_ingest(spark, store, inc, ml)
    t = store.tables()
    assert t.events.count() == 3 and t.source_files.first()["load_count"] == 1
    assert [r["status"] for r in t.ingestion_runs.collect()] == ["success"]


def test_loads_and_replays_check_machine_types(spark, place, write_files):
    put, inc, ml, store = place
    put({F1: DAY1})
    odd = write_files({"machine_list.csv": MACHINES_CSV + "GHOST,Millpond,Zeppelin\n"}, sub="ml3") + "/machine_list.csv"
    s = by_file(run_ingest(spark, store, inc, odd))
    assert s[F1]["status"] == "failed" and "Zeppelin" in s[F1]["error_message"]
    run_ingest(spark, store, inc, ml)
    with pytest.raises(ValueError, match="Zeppelin"):
        replay_rejected(spark, store, odd, "machine_not_in_machine_list")
    assert store.tables().machines.where("ref_no = 'GHOST'").count() == 0


def test_only_touched_dates_are_read(spark, place):
    put, inc, ml, store = place
    put({F1: DAY1, F2: DAY2})
    run_ingest(spark, store, inc, ml)
    t = store.tables()
    rows = spark.sql(
        "select 'QX70' ref_no, timestamp_ntz'2026-09-08 13:00:00' event_time, 'IMPACT' event_type, 5L run_hours_seconds, 'Millpond' reported_branch,"
        " named_struct('driver_key', 'a') driver, 'f' file_name, 2L source_line, false is_late_arrival, false branch_mismatch"
    )
    plan = L.new_events(t.events, rows, t.branches, "x", F.current_timestamp())._jdf.queryExecution().toString()
    assert "2026-09-08" in plan[plan.index("PartitionFilters") :].split("\n")[0]
