"""Records that span lines, stray quotes, and blocks of any size (A4), against a line-by-line reader."""

import random

from pyspark.sql import functions as F

from hourmeter.sources import files as FS

from .helpers import FILE, HDR, clean_texts


def by_hand(lines, most):
    """(line_no, raw_line, stray) read from top to bottom."""
    out, i = [], 0
    while i < len(lines):
        if lines[i].count('"') % 2 == 0:
            out.append((i + 1, lines[i], False))
            i += 1
            continue
        end = next((j for j in range(i + 1, len(lines)) if lines[j].count('"') % 2), None)
        if end is None and len(lines) - 1 - i <= most:
            end = len(lines) - 1
        if end is None or end - i > most:
            out.append((i + 1, lines[i], True))
            i += 1
        else:
            out.append((i + 1, "\n".join(lines[i : end + 1]), False))
            i = end + 1
    return [r for r in out if r[1].strip()]


def test_spans_against_a_line_by_line_reader(spark):
    rnd = random.Random(11)
    files, rows = {}, []
    for f in range(12):
        lines = [rnd.choice(['a,b', 'a,"b', 'c",d', '"x",y', '', '"', 'p,q,r'][: rnd.choice([5, 7])]) for _ in range(rnd.choice([1, 3, 60]))]
        if f >= 9:  # long stretches without quotes
            lines = [x if rnd.random() < 0.15 else "a,b" for x in lines * 3]
        files[f] = lines
        block = rnd.choice([1, 4, 1000])
        rows += [(f"f{f}", f"p{f}", i // block * 10, i + 1, x) for i, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "file_name string, file_path string, block long, line_no long, line string").repartition(3)
    for most in (1, 3, 1000):
        got = sorted((r["file_name"], r["line_no"], r["raw_line"]) for r in FS.records_from_lines(df, most).collect())
        want = sorted((f"f{f}", n, x) for f, lines in files.items() for n, x, _ in by_hand(lines, most))
        assert got == want
        stray = {(f"f{f}", n) for f, lines in files.items() for n, _, s in by_hand(lines, most) if s}
        ones = {(r["file_name"], r["line_no"]) for r in FS.records_from_lines(df, most).where(F.col("fields") == F.array("raw_line")).collect()}
        assert stray <= ones


def test_one_stray_quote_costs_one_line(spark, write_files):
    def line(k):
        return f"2026-09-07T{k // 3600:02d}:{k // 60 % 60:02d}:{k % 60:02d},QX70,Millpond,Impact,{100 + k},Anna,Smith\n"

    n = 5000
    lines = [line(k) for k in range(n)]
    lines[40] = lines[40].replace("Millpond", '"Millpond')
    lines[3000] = lines[3000].replace("Smith", 'Smith"')
    lines[4500] = lines[4500].replace("Smith", '"Smi\nth"')
    c = clean_texts(spark, write_files, {FILE: HDR + "\n" + "".join(lines)})
    assert c.rows.count() == n - 2
    assert sorted((r["line_no"], r["reason"], r["detail"]) for r in c.rejected.collect()) == [
        (42, "wrong_column_count", "expected 7, got 1"),
        (3002, "wrong_column_count", "expected 7, got 1"),
    ]
    assert c.rows.where(F.col("source_line") == 4502).select("driver.surname").first()[0] == "Smi Th"


def test_no_record_is_longer_than_the_bound(spark):
    df = spark.range(30_000).select(
        F.lit("f").alias("file_name"), F.lit("p").alias("file_path"), F.floor(F.col("id") / 7000).alias("block"),
        (F.col("id") + 1).alias("line_no"), F.when(F.col("id") % 900 == 5, 'a,"b').otherwise("a,b").alias("line"),
    )
    longest = FS.records_from_lines(df).agg(F.max(F.size(F.split("raw_line", "\n"))), F.count("*")).first()
    assert longest[0] <= FS.MAX_RECORD_LINES + 1 and longest[1] > 10_000
