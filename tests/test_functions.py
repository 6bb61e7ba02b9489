import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.operators.periods import burst_flag
from hourmeter.operators.sliced import sliced_lag, sliced_running_max, sliced_running_sum
from hourmeter.sources.files import parse_fields


def test_scalar_functions(spark):
    rows = spark.createDataFrame(
        [("2026-09-08_DailyTelemetryData.csv", 18, "a,b"), ("2026-13-08_dailytelemetrydata.CSV", 17, "x"), ("x.csv", -18, None)],
        "name string, s bigint, r string",
    )
    out = rows.select(
        X.delivery_date_from_name("name").alias("dd"),
        X.data_date_from_name("name").alias("dt"),
        X.hours("s", 2).alias("h2"),
        X.hours(F.col("s") * 10, 1).alias("h1"),
        X.reason_label(F.lit("invalid_run_hours")).alias("rl"),
        X.reason_label(F.lit("some_new_reason")).alias("rl2"),
        X.label_reason_list(F.lit("duplicate_row_in_file (3), machine_not_in_machine_list (1)")).alias("ll"),
        X.day_label(F.to_date(F.lit("2026-09-08"))).alias("lab"),
        X.display_name(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("nd"),
    ).collect()
    assert out[0]["dd"] == dt.date(2026, 9, 8) and out[0]["dt"] == dt.date(2026, 9, 7)
    assert out[1]["dd"] is None and out[2]["dd"] is None
    assert [r["h2"] for r in out] == [0.01, 0.0, -0.01]  # half away from zero
    assert out[0]["h1"] == 0.1 and out[1]["h1"] == 0.0
    assert out[0]["rl"] == "invalid run hours" and out[0]["rl2"] == "some new reason"
    assert out[0]["ll"] == "duplicate rows (3), unknown machine (1)"
    assert out[0]["lab"] == "Tue 8 Sep 2026" and out[0]["nd"] == "No driver logged on"


def test_parameter_normalisers():
    assert X.norm_machine_type_param("forklifts") == "Forklift"
    assert X.norm_machine_type_param("Pallet jack") == "PPT"
    assert X.norm_machine_type_param("crane") == "__unknown__"
    assert X.norm_machine_type_param("  ") is None
    assert X.norm_event_type_param("harsh brakes") == "HARSH_BRAKING"
    assert X.norm_event_type_param("logins") == "DRIVER_CHANGE"
    assert X.norm_event_type_param(None) is None
    assert X.period_param("2026-09-08", "2026-09-07") == (None, None)
    assert X.period_param("2026-09-01", "2026-09-07") == ("2026-09-01", "2026-09-07")
    assert X.period_param("2026-02-30", "2026-03-01") == (None, None)


def test_parse_fields_quotes(spark):
    cases = [
        ('a,"b,c",d', ["a", "b,c", "d"]),
        ('"a""b",,', ['a"b', "", ""]),
        ('x"y,z"w,v', ["xy,zw", "v"]),
        ('"unterminated,still', ["unterminated,still"]),
        ('"",""', ["", ""]),
        ("a\r,b", ["a", "b"]),
        ('"line1\nline2",2', ["line1\nline2", "2"]),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "r string")
    got = [r[0] for r in df.select(parse_fields(F.col("r"))).collect()]
    assert got == [e for _, e in cases]


def _readings(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    base = dt.datetime(2026, 9, 7)
    for i in range(n):
        key = "HOT" if rnd.random() < 0.6 else f"K{rnd.randint(1, 5)}"
        t = base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))
        rows.append((key, t, i, rnd.randint(0, 5000)))
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, id bigint, v bigint")


def test_sliced_operators_match_plain_windows(spark):
    df = _readings(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select(
        "id",
        F.lag("v").over(w).alias("pv"),
        F.lag("t").over(w).alias("pt"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
        F.max(F.when(F.col("v") % 3 == 0, F.col("v"))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rm"),
    )
    hour = F.date_trunc("hour", "t")
    got = sliced_lag(df, ["k"], ["t", "id"], hour, ["v", "t"], prefix="p_")
    got = sliced_running_sum(got, ["k"], ["t", "id"], hour, F.col("v"), "rs")
    got = sliced_running_max(got, ["k"], ["t", "id"], hour, F.when(F.col("v") % 3 == 0, F.col("v")), "rm")
    a = {r["id"]: (r["pv"], r["pt"], r["rs"], r["rm"]) for r in ref.collect()}
    b = {r["id"]: (r["p_v"], r["p_t"], r["rs"], r["rm"]) for r in got.collect()}
    assert a == b


def test_burst_flag_against_brute_force(spark):
    df = _readings(spark, n=400, seed=3)
    got = {r["id"]: (r["hits_in_window"], r["is_limited"]) for r in burst_flag(df, "k", "t", limit=3, window_seconds=600).collect()}
    rows = [(r["k"], r["t"], r["id"]) for r in df.collect()]
    for k, t, i in rows:
        hits = sum(1 for k2, t2, _ in rows if k2 == k and t2 <= t and (t - t2).total_seconds() < 600)
        assert got[i] == (hits, hits > 3)


def test_burst_flag_keeps_null_keys_and_null_times(spark):
    times = [None, "2026-01-01 00:00:00.2", "2026-01-01 00:00:00.9", "2026-01-01 00:00:30", "2026-01-01 00:01:00.2", "2026-01-01 00:01:00.3"]
    rows = [(100 * n + 10 * i + j, k, t) for n, k in enumerate([None, "a", None]) for i, t in enumerate(times) for j in range(1 + i % 2)]
    df = spark.createDataFrame(rows, "id long, k string, t string").withColumn("t", F.col("t").cast("timestamp")).repartition(3)
    frame = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-59_999_999, 0)
    want = {r["id"]: r["n"] for r in df.withColumn("n", F.count(F.lit(1)).over(frame)).collect()}
    out = burst_flag(df, "k", "t", limit=2, window_seconds=60)
    assert out.columns == ["id", "k", "t", "hits_in_window", "is_limited"]
    got = out.collect()
    assert len(got) == len(rows) and {r["id"]: r["hits_in_window"] for r in got} == want
    assert all(r["is_limited"] == (want[r["id"]] > 2) for r in got)


def test_listing_and_fingerprints(spark, tmp_path):
    from hourmeter.sources import files as FS

    d = tmp_path / "in"
    d.mkdir()
    (d / "2026-09-08_DailyTelemetryData.csv").write_text("a\nb\n")
    (d / "2026-09-09_dailytelemetrydata.CSV").write_text("a\nb\n")
    (d / "notes_DailyTelemetryData.csv").write_text("x\n")
    names = sorted(r[0] for r in FS.list_daily_files(spark, str(d)).select("file_name").collect())
    assert names == ["2026-09-08_DailyTelemetryData.csv", "2026-09-09_dailytelemetrydata.CSV"]
    fp = {r[0]: r[1] for r in FS.file_fingerprints(FS.read_lines(spark, str(d))).collect()}
    assert fp["2026-09-08_DailyTelemetryData.csv"] == fp["2026-09-09_dailytelemetrydata.CSV"]
    (d / "2026-09-09_dailytelemetrydata.CSV").write_text("b\na\n")  # same lines, other order
    fp2 = {r[0]: r[1] for r in FS.file_fingerprints(FS.read_lines(spark, str(d))).collect()}
    assert fp2["2026-09-09_dailytelemetrydata.CSV"] != fp["2026-09-09_dailytelemetrydata.CSV"]
