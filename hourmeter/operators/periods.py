"""K4 (sliding-window burst flag) and K5 (relative period labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmeter.model import Tables

# --- Fixed values: relative period labels and the Monday offset of each day name
DAY_NAMES = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
PERIOD_LABELS = ["yesterday", "this week", "last week", *DAY_NAMES]


#: Seconds of a key that a window over whole seconds takes together, or the window's own length if that is longer.
BLOCK_SECONDS = 3600


def burst_flag(df: DataFrame, key: str, ts: str, limit: int, window_seconds: int = 60) -> DataFrame:
    """K4: per key, hits whose age is under ``window_seconds`` (self and same-instant hits
    included); ``is_limited`` when that count exceeds ``limit``.

    Exact, and a bursting key is cut by the second: the window of a hit is part of its own second, whole
    seconds, and part of the second where the window begins.  Both parts are running counts inside one key-second.
    Whole seconds are counted from one row a key-second, and a key's history is cut into blocks of at least the window's
    length: a second counts in its own block and, as history, in the next, so a block has all that its windows reach.
    No task needs more rows together than one key has in one second, or seconds in two blocks.

    Nulls: a null key is a key like any other.  A hit without time stands in no other hit's window; it counts
    the hits of its key without time, as a RANGE frame over nulls does.  No row is lost.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    # a struct that holds the key is never null itself, so joins on it meet null keys too
    base = df.withColumn("_k", F.struct(F.col(key))).withColumn("_us", us).withColumn("_s", F.floor(F.col("_us") / 1_000_000)).withColumn("_f", F.pmod("_us", F.lit(1_000_000)))
    instants = base.groupBy("_k", "_s", "_f").agg(F.count(F.lit(1)).alias("_n"))
    timeless = instants.where("_s is null").select("_k", "_s", "_f", F.col("_n").alias("hits_in_window"))
    instants = instants.where("_s is not null")
    # whole seconds between the window's first second and the hit's own
    block = F.floor(F.col("_s") / max(BLOCK_SECONDS, int(window_seconds)))
    seconds = instants.groupBy("_k", "_s").agg(F.sum("_n").alias("_t")).withColumn("_own", block)
    seconds = seconds.withColumn("_block", F.explode(F.array("_own", F.col("_own") + 1)))
    whole = Window.partitionBy("_k", "_block").orderBy("_s").rangeBetween(-(int(window_seconds) - 1), -1)
    seconds = seconds.withColumn("_whole", F.coalesce(F.sum("_t").over(whole), F.lit(0))).where("_own = _block").select("_k", "_s", "_whole")
    # running counts inside a second, for the hits themselves and for the instants where their windows begin
    hits = instants.select("_k", "_s", "_f", "_n", F.lit(0).alias("_asks"))
    starts = instants.select("_k", (F.col("_s") - int(window_seconds)).alias("_s"), "_f", F.lit(0).alias("_n"), F.lit(1).alias("_asks"))
    second = Window.partitionBy("_k", "_s")
    upto = second.orderBy("_f").rangeBetween(Window.unboundedPreceding, 0)
    counted = hits.unionByName(starts).withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(second)})
    own = counted.where("_asks = 0").select("_k", "_s", "_f", "_upto")
    first = counted.where("_asks = 1").select("_k", (F.col("_s") + int(window_seconds)).alias("_s"), "_f", (F.col("_all") - F.col("_upto")).alias("_after"))
    total = own.join(first, ["_k", "_s", "_f"]).join(seconds, ["_k", "_s"])
    total = total.select("_k", "_s", "_f", (F.col("_upto") + F.col("_after") + F.col("_whole")).alias("hits_in_window")).unionByName(timeless)
    total = total.withColumnsRenamed({"_k": "_k2", "_s": "_s2", "_f": "_f2"})
    same = (F.col("_k") == F.col("_k2")) & F.col("_s").eqNullSafe(F.col("_s2")) & F.col("_f").eqNullSafe(F.col("_f2"))
    out = base.join(total, same, "left")
    return out.withColumn("is_limited", F.col("hits_in_window") > F.lit(limit)).drop("_us", "_k", "_s", "_f", "_k2", "_s2", "_f2")


def relative_periods(t: Tables) -> DataFrame:
    """K5: one row per label with its date range, relative to the latest event date.

    yesterday = the latest day; this week = Monday-Sunday week holding it; last week =
    the week before; a day name = that day of this week.
    """
    latest = t.events.agg(F.max("event_date").alias("latest"))
    monday = F.to_date(F.date_trunc("week", F.col("latest")))
    rows = [
        ("yesterday", F.col("latest"), F.col("latest")),
        ("this week", monday, F.date_add(monday, 6)),
        ("last week", F.date_sub(monday, 7), F.date_sub(monday, 1)),
    ] + [(d, F.date_add(monday, i), F.date_add(monday, i)) for i, d in enumerate(DAY_NAMES)]
    arr = F.array(*[F.struct(F.lit(lab).alias("label"), a.alias("date_from"), b.alias("date_to")) for lab, a, b in rows])
    return latest.select(F.inline(arr))
