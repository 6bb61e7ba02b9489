"""Connected components by alternating large-star and small-star rounds over an edge table.

Each round is two aggregations and two equi-joins; a node with very many neighbours is only a hot join
key, which adaptive execution splits, and its minimum is combined before the shuffle.  Rounds are cut
with tables in the shared checkpoint folder.  Only a count and a checksum reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.llm.frames import saved


def components(spark: SparkSession, edges: DataFrame, name: str, max_rounds: int = 64) -> DataFrame:
    """``edges`` has src and dst.  Returns (node, root) for every node other than the roots themselves;
    root is the smallest node of its component.  Nulls and self-links are ignored."""
    e = edges.where("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct()
    e = saved(spark, e, name)
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        e = saved(spark, small.where("a <> b").distinct(), name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    else:
        raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of n nodes under the links a-b, inside one task."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            break
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
