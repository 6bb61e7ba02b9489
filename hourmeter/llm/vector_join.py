"""Embedding near-duplicates: exact metric range join over pivot cells.

Vectors are compared by the distance of their unit vectors, which is sqrt(2 - 2 cos), so cosine >= c is a
distance of at most r = sqrt(2 - 2c).  A bounded set of pivots partitions the vectors: each is at home with its
nearest pivot.  By the triangle inequality a partner of a vector at distance d from its own pivot and e from
another can only be at home there if e - d <= 2r; the same bound on the plane half-way between two pivots is
(e^2 - d^2) / (2 |p - q|) <= r.  A vector is copied to the cells that both bounds allow, and each cell then joins
alone.  Cells are cut into blocks of bounded size, and a block of homes meets each block of members, so no task
holds a hot cell.  Every candidate is verified by its cosine in double precision.

How many pivots pay depends on the data: clustered vectors are hardly ever copied, while vectors spread evenly in
many dimensions lie near every boundary.  The copies that 1, 4, 16, ... pivots would cause are measured on
``PROBES`` vectors, and the number with the least estimated work is taken; the result is the same for any number.

Equal vectors are merged before the join.  A block returns each home's number of links and a spanning forest of
its links, never the pairs.

Vectors with equal, non-null labels (and equal length) are compared.  Vectors that are null, empty, zero or hold
a null or non-finite component, and rows without label or vec_id, link with nothing: no links, own component.
Rows that repeat a vec_id count as vectors of their own: each has the links and the component of its own vector,
and a component is named by its smallest vec_id.  So unlinked vectors of one vec_id can name their components
alike, and ``kept`` holds for every row that bears its component's id.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.llm import textkernel as TK
from hourmeter.llm.frames import saved
from hourmeter.llm.graph import components, local_roots

MAX_PIVOTS = 512
PROBES = 1_024
BLOCK = 16_384
BLOCK_BYTES = 32 << 20
#: Microseconds to ship a row and to compare a pair, about; they only weigh one number of pivots against another.
ROW_COST, PAIR_COST = 8.0, 0.05
_MARGIN = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of their components in double precision."""
    for batch in batches:
        out = []
        for k, v in enumerate(batch.column(2)):
            v = v.as_py()
            ok = v is not None and len(v) > 0 and None not in v
            x = np.array(v if ok else [0.0], "<f8") + 0.0  # -0.0 becomes 0.0
            if ok and np.isfinite(x).all() and x.any():
                out.append((k, len(x), x.tobytes()))
        at = pa.array([k for k, _, _ in out], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array([d for _, d, _ in out], pa.int32()), pa.array([b for _, _, b in out], pa.binary())],
            ["vec_id", "label", "dim", "vec"],
        )


def _matrix(vec: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vec.to_pylist()), "<f8").reshape(-1, dim)


def _members(x: np.ndarray, p: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For unit vectors and pivots: home cell of each vector, and whether it belongs to each cell."""
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * p @ p.T))
    far = np.sqrt(np.maximum(0.0, 2 - 2 * x @ p.T))
    home = far.argmin(axis=1)
    d = far[np.arange(len(far)), home][:, None]
    plane = (far**2 - d**2) <= 2 * reach * apart[home] + _MARGIN
    member = (far - d <= 2 * reach + _MARGIN) & plane
    member[np.arange(len(far)), home] = True
    return home, member


def block_rows(dim: int) -> int:
    return max(64, min(BLOCK, BLOCK_BYTES // (8 * dim)))


def pivots_that_pay(pivots: np.ndarray, probes: np.ndarray, reach: float, together: float) -> int:
    """Of 1, 4, 16, ... first pivots, the number with the least work for one vector.  ``together`` is how many
    vectors share a vector's label."""
    best, least, k = 1, math.inf, 1
    block = block_rows(pivots.shape[1])
    while k <= len(pivots):
        copies = _members(probes, pivots[:k], reach)[1].sum(axis=1).mean()
        homes = together / k
        rows = math.ceil(copies * homes / block) + copies * math.ceil(homes / block)
        work = ROW_COST * rows + PAIR_COST * copies * homes
        if work < least:
            best, least = k, work
        k *= 4
    return best


def _cells(pivots: dict[int, np.ndarray], reach: float):
    """Homes and copies: a row for each cell that a vector belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x, p = _unit(_matrix(batch.column("vec").take(pa.array(rows)), dim)), pivots[int(dim)]
                for lo in range(0, len(rows), 4_096):
                    home, member = _members(x[lo : lo + 4_096], p, reach)
                    r, c = np.nonzero(member)
                    take = pa.array(rows[lo + r])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(n).take(take) for n in ("node", "label", "dim", "n", "vec")] + [pa.array(c.astype(np.int32)), pa.array(c == home[r])],
                        ["node", "label", "dim", "n", "vec", "cell", "home"],
                    )

    return run


def _join(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        as_home = table.column("as_home").to_numpy(zero_copy_only=False)
        raw = _matrix(table.column("vec").combine_chunks(), dim)
        u = _unit(raw)
        h, m = np.flatnonzero(as_home), np.flatnonzero(~as_home)
        links = np.zeros(len(h), np.int64)
        left, right = [], []
        for lo in range(0, len(h), 512):
            own = h[lo : lo + 512]
            cos = u[own] @ u[m].T
            near = cos >= cosine
            edge = np.argwhere(np.abs(cos - cosine) <= _MARGIN)  # at the limit, the plain formula decides
            for i, j in edge:
                a, b = raw[own[i]], raw[m[j]]
                near[i, j] = float(a @ b) / (math.sqrt(float(a @ a)) * math.sqrt(float(b @ b))) >= cosine
            near &= node[own][:, None] != node[m][None, :]
            links[lo : lo + 512] = near @ n[m]
            i, j = np.nonzero(near)
            root = local_roots(len(node), own[i], m[j])
            child = np.flatnonzero(root != np.arange(len(node)))
            left.append(child)
            right.append(root[child])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        root = local_roots(len(node), a, b)
        child = np.flatnonzero(root != np.arange(len(node)))
        src = np.concatenate([node[h], node[child]])
        dst = np.concatenate([node[h], node[root[child]]])
        some = np.concatenate([links, np.zeros(len(child), np.int64)])
        edge = np.arange(len(src)) >= len(h)
        live = np.where(edge, src != dst, some != 0)
        return pa.table({"node": src[live], "other": dst[live], "links": some[live], "edge": edge[live]})

    return run


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    reach = math.sqrt(2 - 2 * cosine)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.where("vec_id is not null and label is not null").mapInArrow(TK.tidied(_usable), "vec_id long, label string, dim int, vec binary")
    good = saved(spark, good.withColumn("key", F.unhex(F.md5(F.concat(F.encode("label", "UTF-8"), F.lit(b"\0"), "vec")))), "vectors")
    distinct = good.groupBy("key", "label", "dim", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
    # a vec_id can stand on several vectors, so each vector has a number of its own, fixed by the table
    distinct = saved(spark, distinct.withColumn("node", F.monotonically_increasing_id()), "vectors-distinct")
    labels = distinct.groupBy("dim", "label").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sizes = labels.groupBy("dim").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("together")).collect()  # vector lengths
    pivots = {}
    for r in sizes:
        drawn = distinct.where(F.col("dim") == r["dim"]).orderBy("key").limit(MAX_PIVOTS + PROBES).select("vec").collect()
        drawn = _unit(_matrix(pa.array([bytes(x["vec"]) for x in drawn], pa.binary()), r["dim"]))
        first = drawn[: min(MAX_PIVOTS, max(1, len(drawn) // 2))]
        probes = drawn[len(first) :] if len(drawn) > len(first) else drawn
        pivots[r["dim"]] = first[: pivots_that_pay(first, probes, reach, r["together"])]
    cells = distinct.mapInArrow(TK.tidied(_cells(pivots, reach)), "node long, label string, dim int, n long, vec binary, cell int, home boolean")
    cells = saved(spark, cells, "vectors-cells")
    counts = cells.groupBy("label", "dim", "cell").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("members"))
    block = F.greatest(F.lit(64), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_BYTES // 8) / F.col("dim"))))  # block_rows()
    counts = counts.select("label", "dim", "cell", F.ceil(F.col("homes") / block).cast("int").alias("hb"), F.ceil(F.col("members") / block).cast("int").alias("mb")).where("hb > 0")
    placed = cells.join(counts, ["label", "dim", "cell"])
    spread = F.xxhash64("vec")
    cut = ["node", "label", "dim", "n", "vec", "cell"]
    homes = placed.where("home").select(*cut, F.lit(True).alias("as_home"), F.pmod(spread, F.col("hb")).cast("int").alias("h"), F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("m"))
    members = placed.select(*cut, F.lit(False).alias("as_home"), F.explode(F.sequence(F.lit(0), F.col("hb") - 1)).alias("h"), F.pmod(spread, F.col("mb")).cast("int").alias("m"))
    found = homes.unionByName(members).groupBy("label", "dim", "cell", "h", "m").applyInArrow(_join(cosine), "node long, other long, links long, edge boolean")
    found = saved(spark, found, "vectors-links")
    links = found.where("not edge").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(spark, found.where("edge").select(F.col("node").alias("src"), F.col("other").alias("dst")), "vectors-components")
    rooted = distinct.select("key", "node", "n", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(ids, "root").join(links, "node", "left")
    named = named.select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = good.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    return linked.unionByName(_alone(rows, good)).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _alone(rows: DataFrame, good: DataFrame) -> DataFrame:
    """Rows that can't link: by the same test as ``_usable``, in built-in functions."""
    v = F.col("embedding")
    bad_part = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    usable = v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad_part, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    usable = usable & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
