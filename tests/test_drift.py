"""Payload documents of a shape that has drifted: typed fields, and every departure named."""

import json

from pyspark.sql import functions as F

from hourmeter.sources.drift import explode_drifting
from hourmeter.sources.payload import explode_payload, payload_documents

from .helpers import FILE, HDR, clean_texts


def drift_of(p):
    return [(r["section"], r["place"], r["field"], r["kind"], r["value"]) for r in p.drift.collect()]


def test_documents_of_the_known_shape_read_the_same(spark, write_files):
    text = HDR + "\n2026-09-07T06:00:00,QX70,Millpond,Impact,100,Anna,Smith\n2026-09-07T06:10:00,QX70,Millpond,Speeding,400,,\n2026-09-07T06:20:00,ZZZ9,Millpond,Impact,500,,\n"
    c = clean_texts(spark, write_files, {FILE: text})
    docs = payload_documents(c.rows, c.rejected).checkpoint()
    full = json.dumps({
        "file": {"file_name": "b.csv", "delivery_date": "2026-09-08", "data_date": "", "checksum": "x"},
        "summary": {"rows_read": 2, "rows_clean": 1, "rows_rejected": 1, "rejected_by_reason": {"a": 1}, "late_arrival_rows": 0, "branch_mismatch_rows": 0},
        "machines": [{"ref_no": "QX70", "branch": "Millpond", "machine_type": "PPT"}] * 2,
        "run": {"started_at": "2026-09-08T01:02:03", "triggered_by": "manual"}, "rows": None,
    })
    docs = docs.unionByName(spark.createDataFrame([(full,)], "value string"))
    new, old = explode_drifting(docs), explode_payload(docs)
    assert drift_of(new) == [] and new.failures.count() == 0
    for t in ("files", "rows", "rejected", "machines"):
        a, b = getattr(new, t), getattr(old, t)
        assert a.columns == b.columns and a.dtypes == b.dtypes
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_every_departure_is_named(spark):
    doc = {
        "file": {"file_name": "a.csv", "delivery_date": "soon", "size": 9}, "sender": {"depot": "é"}, "summary": [1], "machines": "none", "run": None,
        "rows": [
            {"ref_no": "A", "source_line": 2, "event_time": "2024-01-01T00:00:01", "run_hours_seconds": "17", "driver": {"surname": "Li", "badge": 4}, "is_late_arrival": "true"},
            {"ref_no": 7, "source_line": 2.5, "event_time": 5, "run_hours_seconds": "17 h", "driver": "Li", "branch_mismatch": "perhaps", "event_type": ["x"]},
            {"source_line": 4, "run_hours_seconds": True}, 12, None, {}, {"ref_no": "B", "run_hours_seconds": "", "driver": None, "": 0},
        ],
        "rejected": [{"line_no": 9, "raw_line": "x", "why": None}, {"line_no": "nine"}],
    }
    p = explode_drifting(spark.createDataFrame([(json.dumps(doc),)], "value string"))
    want = {
        ("document", -1, "file.delivery_date", "mistyped"), ("document", -1, "file.size", "extra"), ("document", -1, "sender", "extra"),
        ("document", -1, "summary", "mistyped"), ("document", -1, "machines", "mistyped"), ("rows", 0, "driver.badge", "extra"),
        ("rows", 1, "source_line", "mistyped"), ("rows", 1, "event_time", "mistyped"), ("rows", 1, "run_hours_seconds", "mistyped"),
        ("rows", 1, "driver", "mistyped"), ("rows", 1, "branch_mismatch", "mistyped"), ("rows", 1, "event_type", "mistyped"),
        ("rows", 2, "run_hours_seconds", "mistyped"), ("rows", 2, "ref_no", "missing"), ("rows", 3, "", "mistyped"), ("rows", 4, "", "mistyped"),
        ("rows", 5, "ref_no", "missing"), ("rows", 6, "", "extra"), ("rejected", 0, "why", "extra"), ("rejected", 1, "line_no", "mistyped"), ("rejected", 1, "line_no", "missing"),
    }
    assert {r[:4] for r in map(tuple, p.drift.select("section", "place", "field", "kind").collect())} == want and p.drift.count() == len(want)
    values = {r[:4]: r[4] for r in drift_of(p)}
    assert values["document", -1, "sender", "extra"] == '{"depot":"é"}' and values["rows", 1, "run_hours_seconds", "mistyped"] == '"17 h"'
    assert values["rows", 3, "", "mistyped"] == "12" and values["rows", 2, "ref_no", "missing"] is None
    whole = {r["place"]: json.loads(r["element"]) for r in p.drift.where("section = 'rows'").collect()}
    assert whole == {i: x for i, x in enumerate(doc["rows"])}
    got = {r["ref_no"]: r for r in p.rows.collect()}
    assert set(got) == {"A", "7", "B"}
    assert got["A"]["run_hours_seconds"] == 17 and got["A"]["is_late_arrival"] is True and got["A"]["driver"]["surname"] == "Li"
    assert got["7"]["run_hours_seconds"] is None and got["7"]["driver"] is None and got["7"]["branch_mismatch"] is False
    assert p.files.select("file_name", "delivery_date", "triggered_by").collect()[0] == ("a.csv", None, "schedule")


def test_documents_that_cannot_be_read_are_kept_whole(spark):
    bad = [None, "", "not json", "[1]", "null", '{"rows": []}', '{"file": {"file_name": ""}}', '{"file": 3}', '{"file": {"file_name": ["a"]}}', '{"file": {"file_name": "a"}, "rows": [], "rows": [1]}']
    docs = spark.createDataFrame([(b, 1) for b in bad], "value string, error int")
    p = explode_drifting(docs)
    assert sorted(map(str, (r["value"] for r in p.failures.collect()))) == sorted(map(str, bad))
    assert p.files.count() == p.rows.count() == p.drift.count() == 0
    empty = explode_drifting(docs.limit(0))
    assert empty.rows.count() == empty.drift.count() == empty.failures.count() == 0
    assert p.failures.where(F.col("error").isNull()).count() == 0
