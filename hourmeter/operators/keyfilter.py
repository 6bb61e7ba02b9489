"""Bloom filters over row keys, as a table that loads append to (A11 asks it which new rows may be stored already).

A filter belongs to a day and a *level*: the number of buckets it was built with, the power of two that gives a bucket about
``KEYS_PER_BUCKET`` keys.  A key's first hash names its bucket, its second ``HASHES`` bits of that bucket's 32,768; a bucket is one
row with a 4 KB bitmap, built by ``bitmap_construct_agg``.  Filters of one day and level merge by
``bitmap_or_agg``; a load of another size brings a level of its own, so no filter has to be built anew as a day grows.

A key whose bits are not all set was never added.  A key whose bits are is probably stored; about one in 400 is not.
Keys must not be null in any column.  Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32_768  # of one bitmap, as bitmap_construct_agg makes it
KEYS_PER_BUCKET = 2_048
HASHES = 4


def _hashes(keys: Sequence[str]) -> tuple[Column, Column]:
    return F.xxhash64(*keys), F.xxhash64(F.lit("bits"), *keys)


def _bit(second: Column, i) -> Column:
    """The i-th bit's place: 15 bits of the second hash each."""
    return F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BITS - 1))


def build_filters(rows: DataFrame, day: str, keys: Sequence[str]) -> DataFrame:
    """(day, level, bucket, bits) of the keys in ``rows``."""
    first, second = _hashes(keys)
    hashed = rows.select(day, first.alias("_first"), second.alias("_second"))
    sizes = hashed.groupBy(day).agg(F.count(F.lit(1)).alias("_n"))  # one row a day
    level = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.col("_n") / KEYS_PER_BUCKET)), F.lit(0))).cast("int").alias("level")
    placed = hashed.join(sizes.select(day, level), day).withColumn("bucket", F.pmod("_first", "level").cast("int"))
    # a bucket's keys (about KEYS_PER_BUCKET, whatever the day) meet before they become bits: combined map-side, every task would
    # send a bitmap of every bucket
    placed = placed.select(day, "level", "bucket", "_second").repartition(day, "level", "bucket")
    bits = placed.select(day, "level", "bucket", F.explode(F.array(*[_bit(F.col("_second"), i) for i in range(HASHES)])).alias("_at"))
    return bits.groupBy(day, "level", "bucket").agg(F.bitmap_construct_agg("_at").alias("bits"))


def merged(filters: DataFrame, day: str) -> DataFrame:
    return filters.groupBy(day, "level", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def may_be_stored(rows: DataFrame, filters: DataFrame, day: str, keys: Sequence[str]) -> DataFrame:
    """The rows of ``rows`` that some filter of their day can't rule out, all columns kept.  A hot day's rows meet its levels
    first (a handful), then their buckets; adaptive execution splits both joins."""
    levels = filters.select(day, "level").distinct()
    first, second = _hashes(keys)
    asked = rows.withColumns({"_first": first, "_second": second}).join(levels, day).withColumn("bucket", F.pmod("_first", "level").cast("int"))
    held = asked.join(merged(filters, day), [day, "level", "bucket"])
    said = F.lit(True)
    for i in range(HASHES):
        at = _bit(F.col("_second"), i)
        byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
        said = said & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return held.where(said).select(*rows.columns).distinct()
