import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from tests.helpers import FILE, HDR, PREFIX, clean_texts

# FILE holds the readings of 7 September 2026


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def line(time="2026-09-07T14:05:09", ref="QX70", branch="Acme Millpond", kind="Speeding", hours="4321", first="Lena", last="Vos"):
    return ",".join([time, ref, branch, kind, hours, first, last])


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-03-29T01:59:58", dt.datetime(2026, 3, 29, 1, 59, 58)),
        ("2026-03-29 01:59:58", dt.datetime(2026, 3, 29, 1, 59, 58)),
        ("05/12/2025 23:00:01", dt.datetime(2025, 12, 5, 23, 0, 1)),
        ("30/02/2025 08:15:00", None),
        ("time of reading", None),
        ("2026-09-07 24:00:00", None),
        ("0099-09-07 10:00:00", None),
    ],
)
def test_event_times(spark, text, expected):
    assert value(spark, X.parse_event_time(F.lit(text))) == expected


def test_names_are_normalised(spark):
    assert value(spark, X.normalise_branch(F.lit("\tacme   old   TOWN "), PREFIX)) == "Old Town"
    assert value(spark, X.normalise_branch(F.lit("Acme Old Town"))) == "Acme Old Town"  # no prefix unless configured
    assert value(spark, X.normalise_branch(F.lit("  "), PREFIX)) is None
    assert value(spark, X.normalise_ref(F.lit("  qx 70"))) == "QX 70"
    assert value(spark, X.normalise_driver(F.lit("LENA"), F.lit("de vos"))).asDict() == {
        "first_name": "Lena",
        "surname": "De Vos",
        "driver_key": "lena de vos",
    }
    assert value(spark, X.normalise_driver(F.lit(""), F.lit("\t"))) is None
    assert value(spark, X.title_case(F.lit("d'arcy smith-jones"))) == "D'Arcy Smith-Jones"
    assert value(spark, X.collapse(F.lit("\ufeff x\u00a0 y \t"))) == "x y"


def test_columns_are_found_by_name_in_any_order(spark, write_files):
    head = "RunHours,Driver Surname,DriverName,Ref No.,Date And Time,Branch Name,TxFlagStrings"
    c = clean_texts(spark, write_files, {FILE: head + "\n77,Vos,Lena,qx70,2026-09-07T02:00:00,Millpond,excess idle\n"})
    (r,) = c.rows.collect()
    assert (r["event_type"], r["run_hours_seconds"], r["driver"]["driver_key"]) == ("EXCESS_IDLE", 77, "lena vos")


def test_each_bad_line_gets_the_first_reason_that_holds(spark, write_files):
    lines = [
        (line(), None, None),
        (line(kind="Wobbling"), "unknown_event_type", "Wobbling"),
        (line(time="2026-09-08T00:00:00", ref="ZZ1", kind="Wobbling"), "timestamp_after_file_delivery", "2026-09-08 00:00:00"),
        (line(ref="ZZ1", kind="Wobbling"), "machine_not_in_machine_list", "ZZ1"),
        (line(), "duplicate_row_in_file", None),
        (line() + ",tail", "wrong_column_count", "expected 7, got 8"),
        (HDR, "repeated_header_row", None),
        (line(ref=" "), "missing_required_value", None),
        (line(time="07.09.2026"), "invalid_timestamp", "07.09.2026"),
        (line(hours="-1"), "invalid_run_hours", "-1"),
    ]
    c = clean_texts(spark, write_files, {FILE: "\r\n".join([HDR, *(text for text, _, _ in lines)])})
    assert [r["source_line"] for r in c.rows.collect()] == [2]
    got = {r["line_no"]: (r["reason"], r["detail"]) for r in c.rejected.collect()}
    assert got == {i + 2: (reason, detail) for i, (_, reason, detail) in enumerate(lines) if reason}
    s = c.summary.first()
    assert (s["rows_read"], s["rows_clean"], s["rows_rejected"]) == (10, 1, 9)
    assert s["rejected_by_reason"] == {reason: 1 for _, reason, _ in lines if reason}


def test_a_late_reading_from_another_branch_is_kept_and_flagged(spark, write_files):
    c = clean_texts(spark, write_files, {FILE: HDR + "\n" + line(time="2026-09-05T11:11:11", ref="t4", branch="ACME  MILLPOND")})
    (r,) = c.rows.collect()
    assert (r["reported_branch"], r["is_late_arrival"], r["branch_mismatch"]) == ("Millpond", True, True)


def test_files_that_cannot_be_read_fail_alone(spark, write_files):
    empty, blank, wrong = "2026-09-09_DailyTelemetryData.csv", "2026-09-10_DailyTelemetryData.csv", "2026-09-11_DailyTelemetryData.csv"
    c = clean_texts(spark, write_files, {FILE: HDR + "\n" + line(branch=""), empty: "", blank: "\n \n", wrong: "Machine,When\nQX70,today\n"})
    errors = {r["file_name"]: r["error"] for r in c.failures.collect()}
    assert set(errors) == {empty, blank, wrong}
    assert errors[empty] == errors[blank] == "File is empty"
    assert errors[wrong].startswith("Missing required column(s): event_time, ref_no")
    (r,) = c.rows.collect()
    assert (r["reported_branch"], r["branch_mismatch"]) == ("Millpond", False)  # blank: the machine's own branch


def test_run_hours_are_whole_seconds(spark, write_files):
    texts = ["", "-9", "3.25", "123456789012345678901", "0", "86400"]
    c = clean_texts(spark, write_files, {FILE: "\n".join([HDR, *(line(hours=t) for t in texts)])})
    assert [(r["reason"], r["detail"]) for r in c.rejected.orderBy("line_no").collect()] == [
        ("missing_required_value", None),
        *[("invalid_run_hours", t) for t in texts[1:4]],
    ]
    assert sorted(r["run_hours_seconds"] for r in c.rows.collect()) == [0, 86400]


@pytest.mark.parametrize("split_bytes", ["128m", "64"])
def test_quotes_and_line_numbers_do_not_depend_on_the_split_size(spark, write_files, split_bytes):
    other = "2026-09-09_DailyTelemetryData.csv"
    text = (
        "\ufeff" + HDR + "\r\n\r\n"
        + line(branch='"Acme, Millpond"', first='"Lena ""L"""', last='"van\nVos"') + "\r\n\n"
        + line(time="2026-09-07T15:00:00", first=" ", last="") + "\r\n"
        + line(time="2026-09-07T16:00:00", first='""', last='""')
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        c = clean_texts(spark, write_files, {FILE: text, other: HDR + "\n\n" + line(time="2026-09-08T01:00:00") + "\n"})
        rows = {(r["file_name"], r["source_line"]): r for r in c.rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(rows) == [(FILE, 3), (FILE, 6), (FILE, 7), (other, 3)]
    quoted = rows[FILE, 3]
    assert (quoted["driver"]["first_name"], quoted["driver"]["surname"], quoted["reported_branch"]) == ('Lena "l"', "Van Vos", ", Millpond")
    assert rows[FILE, 6]["driver"] is None and rows[FILE, 7]["driver"] is None
