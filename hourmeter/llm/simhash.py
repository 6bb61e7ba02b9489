"""SimHash near-duplicates linked through pivot distance tables.

A document's fingerprint has bit i set when more than half of its shingles' XXH64 values have it.
Distinct fingerprints within ``max_bits`` differing bits are linked; a document's group is the set of
documents reachable by links.

Linking: the 64 bits are cut into ``max_bits + 4`` blocks, and for each block the distances of a
fingerprint to a fixed set of reference fingerprints are tabulated.  A pair within ``max_bits`` bits
agrees in all blocks but ``max_bits`` at most, so it has equal coordinates in at least four whole blocks.
Every choice of four blocks gives one cell, named by the coordinates in them; a linked pair meets in at
least one cell.  Inside a cell, pairs whose coordinates differ by more than ``max_bits`` anywhere are
discarded, and survivors are verified by their bits.  A cell of over ``PROBE_FROM`` rows has too many pairs for
that: there, each fingerprint's possible partners, by flips of the bits on which the cell differs, are looked up.
Cells hold distinct fingerprints that agree in about
two thirds of their bits, so a cell has at most 2^22 rows of 8 bytes whatever the corpus; copies were
merged before.  A cell emits a spanning forest of its links, never all pairs.

Nulls: a null text has no words, so its fingerprint is zero, linked like any other.  A null doc_id keeps
its row and takes part as a text, but is never the smallest id of a group unless the group has no other
(component_id is then null).  Repeated rows each get a row.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmeter.llm import textkernel as TK
from hourmeter.llm.frames import saved
from hourmeter.llm.graph import components, local_roots

KEPT_BLOCKS = 4
REFERENCES = 16
#: Cells above this size probe each fingerprint's possible partners instead of comparing neighbours.
PROBE_FROM = 1024
#: Rows of one pivot table: it takes 8 bytes a row, block and reference.
TABLE_ROWS = 16_384

_BYTES = np.uint64(0x0101010101010101)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_fingerprints(col: pa.Array, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """uint64 fingerprint of each whole text: A-Z lower-cased, word shingles joined by a space, repeats
    counted; a text of fewer words is one shingle, a text without words has fingerprint zero."""
    out = np.zeros(len(col), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, j, buf, off in TK.text_slices(col):
        buf = _LOWER[buf]
        start, end, first = TK.words(buf, off)
        text, at = TK.joined(buf, start, end)
        raw = text.tobytes()
        n_words = np.diff(first)
        n_shingles = np.where(n_words == 0, 0, np.maximum(1, n_words - shingle + 1))
        total = int(n_shingles.sum())
        if not total:
            continue
        row = np.repeat(np.arange(j - i), n_shingles)
        begin = np.concatenate([[0], np.cumsum(n_shingles)])
        w = first[:-1][row] + np.arange(total) - begin[:-1][row]
        stop = np.minimum(w + shingle, first[1:][row])
        h = np.fromiter((digest(raw[a:b], seed) for a, b in zip(at[w].tolist(), (at[stop] - 1).tolist(), strict=True)), np.uint64, total)
        # sums of bytes: at most 255 shingles are added before a byte could run over
        live = np.flatnonzero(n_shingles)
        chunks = -(-n_shingles[live] // 255)
        head = np.concatenate([[0], np.cumsum(chunks)])
        inner = np.arange(head[-1]) - np.repeat(head[:-1], chunks)
        cuts = np.repeat(begin[:-1][live], chunks) + inner * 255
        fp = np.zeros(len(live), np.uint64)
        for k in range(8):
            sums = np.add.reduceat((h >> np.uint64(k)) & _BYTES, cuts)
            ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), head[:-1], axis=0)
            for byte in range(8):
                fp |= (2 * ones[:, byte] > n_shingles[live]).astype(np.uint64) << np.uint64(8 * byte + k)
        out[i:j][live] = fp
    return out


def _blocks(max_bits: int) -> list[int]:
    n = max_bits + KEPT_BLOCKS
    at = [64 * b // n for b in range(n + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(at, at[1:], strict=False)]


def _references() -> np.ndarray:
    return TK.mix(np.arange(1, REFERENCES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pivot_table(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Distances of each fingerprint to each reference within each block: (rows, blocks, references)."""
    masks = np.array(_blocks(max_bits), np.uint64)
    return np.bitwise_count((fp[:, None, None] ^ _references()[None, None, :]) & masks[None, :, None])


def _cells(max_bits: int):
    n = max_bits + KEPT_BLOCKS
    choices = list(combinations(range(n), KEPT_BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(col), 50_000):
                fp = col[lo : lo + 50_000]
                table = pivot_table(fp, max_bits).astype(np.uint64)
                with np.errstate(over="ignore"):
                    weight = TK.mix(np.arange(1, REFERENCES + 1, dtype=np.uint64))
                    named = TK.mix((table * weight).sum(axis=2, dtype=np.uint64))
                    for c, blocks in enumerate(choices):
                        key = np.full(len(fp), c + 1, np.uint64)
                        for b in blocks:
                            key = TK.mix(key * np.uint64(0x9E3779B97F4A7C15) + named[:, b])
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["cell", "fp"])

    return run


def _near(fp: np.ndarray, cell: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within max_bits bits in the same cell; rows are sorted by cell."""
    cuts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
    sizes = np.diff(cuts)
    rank = np.arange(len(fp)) - np.repeat(cuts[:-1], sizes)
    room = np.repeat(sizes, sizes)
    small = room <= PROBE_FROM
    tabled, place = fp[small], np.cumsum(small) - 1
    far = np.zeros((len(tabled), REFERENCES), np.int16)  # distances to the whole references
    for lo in range(0, len(tabled), TABLE_ROWS):
        far[lo : lo + TABLE_ROWS] = pivot_table(tabled[lo : lo + TABLE_ROWS], max_bits).sum(axis=1, dtype=np.int16)
    left, right = [], []
    step = 1
    todo = np.flatnonzero(small & (rank + step < room))
    while len(todo):
        a, b = todo, todo + step
        near = np.abs(far[place[a]] - far[place[b]]).max(axis=1) <= max_bits  # maximum coordinate difference
        a, b = a[near], b[near]
        ok = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        left.append(a[ok])
        right.append(b[ok])
        step += 1
        todo = todo[rank[todo] + step < room[todo]]
    for g in np.flatnonzero(sizes > PROBE_FROM):
        lo, hi = cuts[g], cuts[g + 1]
        x = fp[lo:hi]
        order = np.argsort(x)
        s = x[order]
        common = np.bitwise_and.reduce(x ^ ~x[0])  # bits on which the whole cell agrees
        free = [np.uint64(1 << b) for b in range(64) if not (int(common) >> b) & 1]
        for m in range(1, max_bits + 1):
            for bits in combinations(free, m):
                y = x ^ np.bitwise_or.reduce(np.array(bits, np.uint64))
                at = np.minimum(np.searchsorted(s, y), len(s) - 1)
                hit = np.flatnonzero((s[at] == y) & (x < y))
                left.append(lo + hit)
                right.append(lo + order[at[hit]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _links(max_bits: int):
    def flush(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = _near(fp.view(np.uint64), cell, max_bits)
        root = local_roots(len(fp), a, b)
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if len(cell) >= 100_000:
                done = int(np.searchsorted(cell, cell[-1], "left"))  # the last cell may go on
                if done:
                    yield flush(cell[:done], fp[:done])
                    cell, fp = cell[done:], fp[done:]
        if len(cell):
            yield flush(cell, fp)

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, more: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp) and the columns ``more`` for every row of ``docs``; fp is the fingerprint as a signed 64-bit integer."""
    more = more or {}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c.alias(n) for n, c in more.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = text_fingerprints(batch.column(1), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]])

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), *rows.schema.fields[2:]]
    return rows.mapInArrow(TK.tidied(run), T.StructType(fields))


def fingerprint_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (src, dst) that span each cell's groups of fingerprints within ``max_bits``; ``fps`` has distinct fp."""
    cells = fps.select("fp").mapInArrow(TK.tidied(_cells(max_bits)), "cell long, fp long")
    return cells.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(TK.tidied(_links(max_bits)), "src long, dst long").distinct()


def _rooted(spark: SparkSession, marked: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first_id, root) for every distinct fp of ``marked``: its smallest doc_id and its group's smallest fp."""
    copies = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(spark, fingerprint_links(copies, max_bits), "simhash-links")
    return copies.join(roots, copies.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))


def simhash_groups(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marked = saved(spark, fingerprints(docs, shingle), "simhash-fp")
    named = _rooted(spark, marked, max_bits)
    groups = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(groups, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group, all columns kept: the one with the smallest doc_id, then fingerprint,
    then MD5 of the text, then hash of the whole row, so reruns keep the same row.  A doc_id that stands on texts
    of several groups can stay once for each.  Rows without doc_id can't be told apart and stay."""
    cells = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]  # a null is not its neighbour's null
    same = {"_sh_id": F.col("doc_id").cast("long"), "_sh_text": F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))), "_sh_row": F.xxhash64(*cells)}
    named = docs.where(F.col("doc_id").isNotNull())
    marked = saved(spark, fingerprints(named, shingle, {n: same[n] for n in ("_sh_text", "_sh_row")}), "simhash-fp")
    # rows of one fingerprint come down to its first before the groups meet
    key = F.struct("doc_id", "fp", "_sh_text", "_sh_row")
    firsts = marked.groupBy("fp").agg(F.min(key).alias("_sh_first"))
    roots = _rooted(spark, marked, max_bits).select("fp", "root")
    winners = firsts.join(roots, "fp").groupBy("root").agg(F.min("_sh_first").alias("_sh_first"))
    winners = winners.select(F.col("_sh_first.doc_id").alias("_sh_id"), "_sh_first._sh_text", "_sh_first._sh_row")
    several = marked.select(F.col("doc_id").alias("_sh_id"), "_sh_text", "_sh_row").join(winners, list(same), "left_semi").groupBy(*same).agg(F.count(F.lit(1)).alias("_sh_n"))
    kept = named.withColumns(same).join(several, list(same))
    single = kept.where("_sh_n = 1")
    repeated = kept.where("_sh_n > 1").dropDuplicates(list(same))
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(F.col("doc_id").isNull()))
