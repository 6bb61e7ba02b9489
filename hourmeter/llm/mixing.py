"""Mixing sources to target weights by pivotal dependent rounding.

Sources, ordered by code point with null last, take the weights of ``weights`` in turn and share ``share`` of
all words; a target above ``most`` times its source's size stops there, and the excess is shared again by
weight until no target is above.  Every document of a source would be copied target / size times; the whole
part of that is certain, the fraction is rounded by the pivotal method: two documents with fractional copies
meet, words move from one to the other until one of them is integral, the direction drawn so that each keeps
its expectation, and the other goes on.  The words expected of a group stay the same at every meeting, so
only the last document of a source is rounded alone, to the nearer side, and a source's words miss its target by
half of that document at most.  To make that a small one, a bucket's least documents of a source (as many as
could take up twice its largest one either way) meet last, and a larger document that they meet keeps the
direction that it first draws, with its fraction as the chance, until it is integral; a direction for which the smaller
ones haven't enough words isn't taken.  In these last meetings alone the smaller document's expectation isn't kept.
A source's documents meet inside buckets of ``BUCKET_ROWS`` by a hash; each bucket leaves at most one
fractional document, and those meet in a tree of ``FAN_IN`` buckets a node until one bucket is left.  Draws are
hashes of doc_id, so reruns agree.

Rows that repeat doc_id, source and size share one decision.  Nulls: a null text has size 0, a null source is
a source of its own, a null doc_id is an id like any other.  Documents of size 0 take no words; they are
copied as often as the source's fraction, rounded by their own draw.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmeter.llm.frames import saved

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 8_192
FAN_IN = 64
_COLUMNS = "doc_id long, source string, size long, n long, whole long, part double, draw double, bucket long, n_buckets long"


def source_targets(units: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """(source, source_size, n_units, target): one row per source.  ``units`` has source, size and n (equal rows)."""
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    # the level at which sources that are not capped share what is left; rises until no source passes its cap
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        held, free = sizes.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not free or (share * total - (held or 0.0)) / free <= level:
            break
        level = (share * total - (held or 0.0)) / free
    return sizes.select("source", "source_size", "n_units", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _last_ones(source: list, mass: list, part: list) -> list:
    """For rows among the least of their source (those that together could give, and could take, twice as many
    words as its largest fractional document has): the words that they and smaller ones could (give, take)."""
    largest: dict = {}
    for s, m, p in zip(source, mass, part, strict=True):
        if 0.0 < p < 1.0:
            largest[s] = max(m, largest.get(s, 0.0))
    room = {s: (0.0, 0.0) for s in largest}
    last: list = [None] * len(source)
    for i in range(len(source) - 1, -1, -1):
        s, p = source[i], part[i]
        if 0.0 < p < 1.0 and min(room[s]) < 2 * largest[s]:
            last[i] = room[s] = (room[s][0] + mass[i] * p, room[s][1] + mass[i] * (1 - p))
    return last


def _meet(source: list, size: np.ndarray, n: np.ndarray, part: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Rounded parts, in order of rows: per source at most one is left fractional.  Rows come by falling size."""
    part = part.tolist()
    held: dict = {}
    way: dict = {}  # the direction of a source's held document, once drawn
    mass = (size * n).astype(float).tolist()
    draw = draw.tolist()
    last = _last_ones(source, mass, part)
    for i, s in enumerate(source):
        if not 0.0 < part[i] < 1.0:
            continue
        j = held.get(s)
        if j is None:
            held[s] = i
            continue
        a, b, p, q, u = mass[j], mass[i], part[j], part[i], draw[i]
        up, down = min(a * (1 - p), b * q), min(b * (1 - q), a * p)  # words that j could gain or lose
        if last[i]:
            if s not in way:
                gives, takes = last[i]
                up_fits, down_fits = a * (1 - p) <= gives, a * p <= takes
                way[s] = draw[j] * 4096 % 1 < p if up_fits == down_fits else up_fits
            gains = way[s]
        else:
            gains = u * (up + down) < down
        if gains:
            if a * (1 - p) <= b * q:
                part[j], part[i] = 1.0, max(0.0, q - up / b)
            else:
                part[j], part[i] = min(1.0, p + up / a), 0.0
        elif b * (1 - q) <= a * p:
            part[i], part[j] = 1.0, max(0.0, p - down / a)
        else:
            part[i], part[j] = min(1.0, q + down / b), 0.0
        if 0.0 < part[j] < 1.0:
            continue
        way.pop(s, None)
        if 0.0 < part[i] < 1.0:
            held[s] = i
        else:
            del held[s]
    return np.array(part)


def _round(table: pa.Table) -> pa.Table:
    draw = table.column("draw").to_numpy()
    ids = table.column("doc_id").to_pandas().fillna(-1).to_numpy(dtype=np.int64)
    # large documents meet first, so that what is left at the end is small
    order = np.lexsort((draw, ids, -table.column("size").to_numpy()))
    table = table.take(pa.array(order))
    part = _meet(table.column("source").to_pylist(), table.column("size").to_numpy(), table.column("n").to_numpy(), table.column("part").to_numpy(), table.column("draw").to_numpy())
    return table.set_column(table.schema.get_field_index("part"), "part", pa.array(part))


def copies(spark: SparkSession, docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies): one row for each distinct doc_id, source and
    size; n rows of ``docs`` share it, and each of them is taken ``copies`` times."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    units = saved(spark, rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mixing-units")
    targets = saved(spark, source_targets(units, weights, share, most), "mixing-targets")
    most_units = targets.agg(F.max("n_units")).first()[0] or 0
    levels = 1  # until the largest source has one bucket
    while math.ceil(most_units / BUCKET_ROWS) > FAN_IN ** (levels - 1):
        levels += 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    key = F.xxhash64("doc_id", "source", "size")
    draw = F.shiftrightunsigned(F.xxhash64(key, F.lit("draw")), 11) / F.lit(float(1 << 53))
    todo = units.join(targets, units.source.eqNullSafe(targets.source)).select(units.doc_id, units.source, units.size, "n", rate.alias("rate"), F.ceil(F.col("n_units") / F.lit(BUCKET_ROWS)).alias("n_buckets"))
    part = F.col("rate") - F.floor("rate")
    todo = todo.select("doc_id", "source", "size", "n", F.floor("rate").alias("whole"), part.alias("part"), draw.alias("draw"), F.pmod(key, F.col("n_buckets")).alias("bucket"), "n_buckets")
    empty = F.when((F.col("size") == 0) & (F.col("draw") < F.col("part")), 1.0).when(F.col("size") == 0, 0.0).otherwise(F.col("part"))
    todo = todo.withColumn("part", empty)
    settled = []
    fractional = (F.col("part") > 0) & (F.col("part") < 1)
    alone = F.col("n_buckets") == 1  # then what is left is a source's last one
    for _ in range(levels):
        level = saved(spark, todo.groupBy("source", "bucket").applyInArrow(_round, _COLUMNS), "mixing-level")
        settled.append(level.where(alone | ~fractional).withColumn("part", F.when(alone, F.round("part")).otherwise(F.col("part"))))
        todo = level.where(fractional & ~alone).withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
        todo = todo.withColumn("n_buckets", F.ceil(F.col("n_buckets") / F.lit(FAN_IN)))
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    named = targets.withColumnRenamed("source", "of")
    done = done.join(named, F.col("source").eqNullSafe(F.col("of")))
    return done.select("doc_id", "source", "size", "n", "source_size", "target", (F.col("whole") + F.col("part").cast("long")).alias("copies"))


def mix(spark: SparkSession, docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns kept."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    taken = copies(spark, docs, weights, share, most).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"), F.col("copies").alias("_mix_copies"))
    rows = docs.withColumns({"_mix_a": F.col("doc_id").cast("long"), "_mix_b": F.col("source").cast("string"), "_mix_c": size})
    same = F.col("_mix_a").eqNullSafe(F.col("_mix_id")) & F.col("_mix_b").eqNullSafe(F.col("_mix_source")) & (F.col("_mix_c") == F.col("_mix_size"))
    rows = rows.join(taken, same).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
