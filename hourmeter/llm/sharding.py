"""Resharding by minimum-cost flow: move the fewest bytes from old shards into new capacities.

Documents are cut into blocks by a hash of their text, ``blocks`` for each old shard, so equal texts always
share a block and a shard.  Block sizes (a fixed number of rows, whatever the corpus) reach the driver, where
a minimum-cost flow from old shard sizes to new capacities is solved: bytes that stay in their shard cost
nothing, moved bytes cost one each.  Whole blocks then realise the flow, and small blocks are moved on until
the shards' sizes differ by less than about one block.  Documents take their block's shard in a join, and a
gapless slot inside the shard from counts by (shard, bucket of doc_id), so no task holds a whole shard.
``rewrite`` writes only the shards that lose or gain a block and deletes old shards that are left empty.

A group of equal texts is never split; if one is larger than a shard's capacity, its shard is that large.

Nulls: a null text has no bytes (size 1, CRC 0) and is equal to other null texts, not to empty ones; a null
doc_id keeps its row.  Repeated rows each get a slot.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCKS = 2_048
ROWS_A_BUCKET = 100_000


def min_cost_flow(supply: list[int], demand: list[int], cost) -> dict[tuple[int, int], int]:
    """Flow (source, sink) -> amount that meets all supply within the demands at least cost: successive
    shortest paths with potentials over the bipartite graph.  The demands must hold all supply."""
    n, m = len(supply), len(demand)
    s, t = n + m, n + m + 1
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]  # [to, room, cost, index of reverse]

    def edge(a: int, b: int, room: int, c: float) -> None:
        graph[a].append([b, room, c, len(graph[b])])
        graph[b].append([a, 0, -c, len(graph[a]) - 1])

    for i, x in enumerate(supply):
        edge(s, i, x, 0)
        for j in range(m):
            edge(i, n + j, x, cost(i, j))
    for j, x in enumerate(demand):
        edge(n + j, t, x, 0)
    left, potential = sum(supply), [0.0] * (n + m + 2)
    while left > 0:
        far, came = [math.inf] * (n + m + 2), [None] * (n + m + 2)
        far[s], queue = 0.0, [(0.0, s)]
        while queue:
            d, v = heapq.heappop(queue)
            if d > far[v]:
                continue
            for k, (to, room, c, _) in enumerate(graph[v]):
                new = d + c + potential[v] - potential[to]
                if room > 0 and new < far[to] - 1e-12:
                    far[to], came[to] = new, (v, k)
                    heapq.heappush(queue, (new, to))
        if came[t] is None:
            raise ValueError("capacities do not hold all shards")
        potential = [p + (f if f < math.inf else 0) for p, f in zip(potential, far, strict=True)]
        amount, v = left, t
        while v != s:
            v, k = came[v]
            amount = min(amount, graph[v][k][1])
        v = t
        while v != s:
            v, k = came[v]
            graph[v][k][1] -= amount
            graph[graph[v][k][0]][graph[v][k][3]][1] += amount
        left -= amount
    return {(i, to - n): supply[i] - room for i in range(n) for to, room, _, _ in graph[i] if n <= to < n + m and supply[i] > room}


def place_blocks(blocks: dict[tuple[int, int], int], n_new: int) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard, from block sizes."""
    total = sum(blocks.values())
    old = sorted({o for o, _ in blocks})
    supply = [sum(x for (o, _), x in blocks.items() if o == k) for k in old]
    demand = [total // n_new + (k < total % n_new) for k in range(n_new)]
    flow = min_cost_flow(supply, demand, lambda i, j: 0.0 if old[i] == j else 1.0)
    out: dict[tuple[int, int], int] = {}
    load = [0] * n_new
    for i, o in enumerate(old):
        room = {j: x for (a, j), x in flow.items() if a == i}
        for key in sorted((k for k in blocks if k[0] == o), key=lambda k: (-blocks[k], k)):
            j = max(room, key=lambda x: (room[x], x == o, -x), default=o % n_new)
            if room:
                room[j] -= blocks[key]
            out[key] = j
            load[j] += blocks[key]
    # whole blocks overshoot: move blocks from the fullest to the emptiest shard while that evens them out
    held: dict[int, list] = {j: sorted((blocks[k], k) for k in out if out[k] == j) for j in range(n_new)}
    for _ in range(20 * len(blocks)):
        hi, lo = max(range(n_new), key=lambda j: (load[j], -j)), min(range(n_new), key=lambda j: (load[j], j))
        gap = load[hi] - load[lo]
        fits = [x for x in held[hi] if 0 < x[0] < gap]
        if not fits:
            movable = [h for h in sorted(range(n_new), key=lambda j: -load[j]) if any(0 < x[0] < load[h] - load[lo] for x in held[h])]
            if not movable or load[movable[0]] <= total / n_new:
                break
            hi = movable[0]
            gap = load[hi] - load[lo]
            fits = [x for x in held[hi] if 0 < x[0] < gap]
        best = min(fits, key=lambda x: (abs(2 * x[0] - gap), x))
        held[hi].remove(best)
        held[lo].append(best)
        held[lo].sort()
        out[best[1]] = lo
        load[hi] -= best[0]
        load[lo] += best[0]
    return out


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with _sh_size: UTF-8 bytes of the text (null: none) plus 1."""
    return docs.withColumn("_sh_size", (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 1).cast("long"))


def old_shard_by_hash(n_old: int):
    """The layout that a corpus without shards starts from: by hash of the text."""
    return F.pmod(F.xxhash64(F.col("text").cast("string"), F.lit("old")), F.lit(n_old)).cast("int")


def reshard(spark: SparkSession, docs: DataFrame, old_shard, n_new: int, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with _sh_size, _sh_old, _sh_new and _sh_slot (gapless from 0 in its shard).  ``old_shard`` is the
    column that holds the present shard; equal texts must have equal old shards."""
    text = F.col("text").cast("string")
    # null and empty texts hash alike, so they share a block; that is allowed
    rows = with_size(docs).withColumns({"_sh_old": old_shard, "_sh_block": F.pmod(F.xxhash64(text, F.lit("block")), F.lit(blocks)).cast("int")})
    sizes = rows.groupBy("_sh_old", "_sh_block").agg(F.sum("_sh_size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()  # blocks x old shards at most
    placed = place_blocks({(r["_sh_old"], r["_sh_block"]): r["bytes"] for r in sizes}, n_new)
    n_buckets = max(8, math.ceil(sum(r["n"] for r in sizes) / ROWS_A_BUCKET))
    plan = spark.createDataFrame([(o, b, j) for (o, b), j in placed.items()], "_sh_old int, _sh_block int, _sh_new int")
    rows = rows.join(F.broadcast(plan), ["_sh_old", "_sh_block"])  # as many rows as sizes
    rows = rows.withColumn("_sh_bucket", F.pmod(F.xxhash64("doc_id", "_sh_size"), F.lit(n_buckets)))
    counts = rows.groupBy("_sh_new", "_sh_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_sh_new").orderBy("_sh_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_sh_new", "_sh_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_sh_start"))
    inside = F.row_number().over(Window.partitionBy("_sh_new", "_sh_bucket").orderBy("doc_id", "_sh_size"))
    rows = rows.withColumn("_sh_at", inside).join(starts, ["_sh_new", "_sh_bucket"])
    rows = rows.withColumn("_sh_slot", (F.col("_sh_start") + F.col("_sh_at") - 1).cast("long"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], "_sh_size", "_sh_old", "_sh_new", "_sh_slot")


def rewrite(resharded: DataFrame, path: str, n_new: int) -> list[int]:
    """Write the shards that lose or gain rows, one folder ``shard=<k>`` each, and return their numbers; a shard
    whose rows all stay keeps its old files.  ``path`` may hold the old layout, and ``resharded`` may read it: new
    files are staged and take their folders' place once all are written, and only then the folders of old shards
    that have no rows any more go.  Only shard numbers reach the driver."""
    pairs = resharded.select("_sh_old", "_sh_new").distinct().collect()  # old x new shards at most
    moved = {k for r in pairs if r["_sh_old"] != r["_sh_new"] for k in (r["_sh_old"], r["_sh_new"])}
    touched = sorted(k for k in moved if k < n_new)
    out = resharded.where(F.col("_sh_new").isin(touched)).withColumn("shard", F.col("_sh_new")).drop("_sh_old", "_sh_new")
    write = out.repartition("shard", F.floor(F.col("_sh_slot") / ROWS_A_BUCKET)).write.mode("overwrite")
    write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("shard").parquet(path)
    spark = resharded.sparkSession
    for k in sorted(moved - {r["_sh_new"] for r in pairs}):
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/shard={k}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return touched
