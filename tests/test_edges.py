"""Edge cases: Unicode spaces in fields, readings across midnight."""

import datetime as dt

from hourmeter.operators import intervals as IV

from .helpers import FILE, HDR, clean_texts


def test_nbsp_in_fields(spark, write_files):
    text = HDR + "\n" + "2026-09-07T06:00:00,\u00a0qx70\u00a0,Acme\u00a0\u00a0Millpond,Impact\u00a0,100,Jo\u00a0,Smith\n"
    c = clean_texts(spark, write_files, {FILE: text})
    r = c.rows.first()
    assert (r["ref_no"], r["reported_branch"], r["event_type"]) == ("QX70", "Millpond", "IMPACT")
    assert r["driver"]["driver_key"] == "jo smith"


def test_fingerprint_and_lines_do_not_depend_on_the_split_size(spark, write_files):
    from hourmeter.sources import files as FS

    d = write_files({FILE: "\n".join(f"row {i},\u00e9" for i in range(500))}, sub="odd [name] 100% #1")
    path = FS.list_daily_files(spark, d).first()["path"]
    before, seen = spark.conf.get("spark.sql.files.maxPartitionBytes"), set()
    try:
        for size in ("128m", "1000", "77"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = FS.read_lines(spark, [path])
            numbers = sorted(r["line_no"] for r in lines.collect())
            seen.add((FS.file_fingerprints(lines).first()["checksum"], tuple(numbers)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(seen) == 1 and next(iter(seen))[1] == tuple(range(1, 501))


def test_no_carry_across_midnight(spark):
    ev = spark.createDataFrame(
        [
            ("M1", dt.datetime(2026, 9, 7, 23, 50), 100, "a", 1),
            ("M1", dt.datetime(2026, 9, 8, 0, 10), 1300, "a", 2),  # first reading of the day: no interval
            ("M1", dt.datetime(2026, 9, 8, 0, 20), 2500, "a", 3),  # +1200 in 600 s: capped
        ],
        "ref_no string, event_time timestamp_ntz, run_hours_seconds bigint, file_name string, source_line bigint",
    ).selectExpr(
        "*", "to_date(event_time) AS event_date", "'IMPACT' AS event_type", "CAST(NULL AS STRING) AS driver_key",
        "1 AS event_branch_id",
    )
    out = IV.run_intervals(ev).collect()
    assert [(str(r["event_date"]), r["clock_seconds"], r["run_seconds"], r["is_capped"]) for r in out] == [
        ("2026-09-08", 600, 600, True)
    ]


def test_new_events_drop_stored_rollups():
    from hourmeter.model import Tables

    t = Tables(*["x"] * 6, interval_days="iv", event_days="ev")
    assert (t.with_(events="e2").interval_days, t.with_(events="e2").event_days) == (None, None)
    kept = t.with_(events="e2", interval_days="iv2", event_days="ev2")
    assert (kept.interval_days, kept.event_days) == ("iv2", "ev2")
    assert t.with_(rejected_rows="r").interval_days == "iv"
