"""Payload documents written in blocks and read back (I2), and the machine list reader's rules (A5)."""

import json

from pyspark.sql import functions as F

from hourmeter.sources import files as FS
from hourmeter.sources.payload import explode_payload, payload_documents

from .helpers import FILE, HDR, clean_texts

TEXT = (
    HDR + "\n"
    "2026-09-07T06:00:00,QX70,Millpond,Impact,100,Anna,Smith\n"
    "2026-09-07T06:10:00,QX70,Millpond,Speeding,400,,\n"
    "2026-09-07T06:10:00,QX70,Millpond,Speeding,400,,\n"
    "2026-09-07T06:20:00,ZZZ9,Millpond,Impact,500,,\n"
    "2026-09-07T06:30:00,T4,Quayside,Power Up,50,Bo,Li\n"
)


def test_payload_documents_round_trip(spark, write_files):
    c = clean_texts(spark, write_files, {FILE: TEXT})
    docs = payload_documents(c.rows, c.rejected, block_lines=2)
    # each document holds one block of at most two lines of one file
    sizes = [
        len(d.get("rows", [])) + len(d.get("rejected", []))
        for d in (json.loads(r["value"]) for r in docs.collect())
    ]
    assert max(sizes) <= 2 and sum(sizes) == 5
    p = explode_payload(docs)
    key = ["file_name", "source_line", "ref_no", "event_time", "event_type", "run_hours_seconds", "reported_branch"]
    got = sorted(tuple(r) for r in p.rows.select(*key, F.col("driver.driver_key").alias("dk")).collect())
    want = sorted(tuple(r) for r in c.rows.select(*key, F.col("driver.driver_key").alias("dk")).collect())
    assert got == want and len(got) == 3
    assert sorted((r["line_no"], r["reason"]) for r in p.rejected.collect()) == [
        (4, "duplicate_row_in_file"),
        (5, "machine_not_in_machine_list"),
    ]


def test_machine_list_rules(spark, write_files):
    text = (
        "MachineType,BranchName,RefNo.\n"
        "PPT,Acme Old Yard,QX70\n"  # stale line: the later one wins
        "Forklift  ,ACME  MILLPOND, qx70 \n"
        "Reach Truck,Quayside,\n"  # blank ref: skipped
        "PPT,acme north  gate,T4\n"
    )
    d = write_files({"machine_list.csv": text}, sub="ml2")
    got = sorted(tuple(r) for r in FS.read_machine_list(spark, d + "/machine_list.csv", "acme").collect())
    assert got == [("QX70", "Millpond", "Forklift"), ("T4", "North Gate", "PPT")]
