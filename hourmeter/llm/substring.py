"""Substring dedup: words covered by a passage that also stands in a document with a smaller doc_id.

A passage is ``window`` consecutive words of one document.  The work is a suffix tree over words, cut by
prefix into groups that fit in memory:

1. *Anchors.*  In every window the five-word gram with the least hash is its anchor, so equal windows have
   equal anchors at the same offset.  Suffixes are indexed at anchors only (about a fifth of the words).
2. *Prefix census.*  Anchors whose gram stands in one document only can't start a repeat; they are dropped
   by an aggregation of (gram, doc_id).  Whole copies of a text are dropped here too: they share one leaf.
3. *Contexts.*  Around each remaining anchor, the words of the windows that it anchors are cut out, as far
   as they reach left and right; equal contexts are merged before the shuffle to one leaf with its
   smallest doc_id.
4. *Subtrees.*  Leaves go to tasks by range of their suffix's first five words, so a task holds whole
   subtrees.  A prefix that has more than ``max_leaves`` leaves is extended to all ``window`` words: its
   windows become leaves of their own and are merged by a plain aggregation, however many there are.
   In a task, suffixes sorted by word with their common prefix lengths are the subtree; the left contexts,
   sorted in the same way, tell the nodes' left extensions.  A node of ``window`` words in all is a repeat;
   its smallest doc_id is that of its leaves.
5. *Spans.*  Each occurrence of a leaf takes the repeats that start in a smaller document; the covered words
   of a document are the union of its maximal repeats.

Grams are compared by a 64-bit hash only to drop suffixes (a collision keeps one too many); the trees compare
words by their bytes.  Equal texts and leaves are recognised by MD5.

Nulls: a null text has no words.  A row without doc_id neither loses words nor makes others lose any.  Rows
that repeat a doc_id are treated each by its own text; equal doc_ids are never smaller than each other.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmeter.llm import textkernel as TK
from hourmeter.llm.frames import discard, saved

GRAM = 5
WINDOW = 13
MAX_LEAVES = 200_000
NONE = np.iinfo(np.int64).max


def _anchored(buf: np.ndarray, off: np.ndarray, window: int):
    """Words, their grams' hashes, and for each anchor its word and the first and last window it anchors."""
    start, end, first = TK.words(buf, off)
    n = len(start)
    if n < window:
        return start, end, first, None
    wh = TK.word_hash(buf, start, end)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    g = TK.gram_hash(wh, GRAM)
    span = window - GRAM + 1
    low = TK.sliding_min(g, span)  # of each window; n - window + 1 of them
    low = np.where(row[: n - window + 1] == row[window - 1 :], low, np.uint64(0))
    padded = np.zeros(len(g) + span - 1, np.uint64)
    padded[span - 1 : span - 1 + len(low)] = low
    high = ~TK.sliding_min(~padded, span)  # over the windows that hold the gram
    at = np.flatnonzero((high == g) & (g > 0))
    return start, end, first, (g, low, row, at, span)


def _census(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, buf, off in TK.text_slices(batch.column(1)):
                *_, found = _anchored(buf, off, window)
                if found is None:
                    continue
                g, _, row, at, _ = found
                yield pa.RecordBatch.from_arrays([pa.array(g[at].view(np.int64)), pa.array(ids[i:j][row[at]])], ["gram", "doc_id"])

    return run


def _contexts(window: int):
    """From (doc_id, text_key, text, grams): a row for each anchor among the grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for i, j, buf, off in TK.text_slices(batch.column(2)):
                start, end, _, found = _anchored(buf, off, window)
                if found is None:
                    continue
                g, low, row, at, span = found
                shared = np.unique(pa.ListArray.flatten(batch.column(3)[i:j]).to_numpy(zero_copy_only=False).view(np.uint64))
                where = np.minimum(np.searchsorted(shared, g[at]), max(0, len(shared) - 1))
                at = at[shared[where] == g[at]] if len(shared) else at[:0]
                if not len(at):
                    continue
                lo, hi = at.copy(), np.full(len(at), -1)
                for o in range(span):
                    w = at - o
                    ok = (w >= 0) & (w < len(low))
                    ok &= low[np.clip(w, 0, len(low) - 1)] == g[at]
                    lo = np.where(ok, w, lo)
                    hi = np.where(ok & (hi < 0), w, hi)
                text, pos = TK.joined(buf, start, end)
                raw = text.tobytes()
                first_word = np.searchsorted(row, row[at], "left")
                cut = [raw[a:b] for a, b in zip(pos[lo].tolist(), (pos[hi + window] - 1).tolist(), strict=True)]
                prefix = [raw[a:b] for a, b in zip(pos[at].tolist(), (pos[at + GRAM] - 1).tolist(), strict=True)]
                take = pa.array(row[at] + i)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), keys.take(take), pa.array((lo - first_word).astype(np.int64)), pa.array((at - lo).astype(np.int32)), pa.array(cut, pa.binary()), pa.array(prefix, pa.binary())],
                    ["doc_id", "text_key", "word", "anchor", "context", "prefix"],
                )

    return run


def _tree_classes(cols: np.ndarray) -> np.ndarray:
    """Node of each row at every depth: rows are word sequences (ids, -1 past the end).  Sorting them and
    taking neighbours' common prefix lengths gives the tree; the node at depth t changes where the common
    prefix is shorter than t.  Returns (rows, depth + 1)."""
    n, depth = cols.shape
    order = np.lexsort(cols.T[::-1]) if depth else np.arange(n)
    s = cols[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    nodes = np.zeros((n, depth + 1), np.int64)
    for t in range(1, depth + 1):
        nodes[order[1:], t] = np.cumsum(common < t)
    return nodes


def _subtree(context: list[bytes], anchor: np.ndarray, least: np.ndarray, window: int) -> np.ndarray:
    """Smallest doc_id of each window of each leaf; (leaves, span), by window, NONE past the last one."""
    n, span = len(context), window - GRAM + 1
    buf, off = TK.utf8(pa.array(context, pa.binary()))
    start, end, first = TK.words(buf, off)
    raw = buf.tobytes()
    ids = pa.array([raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], pa.binary()).dictionary_encode().indices.to_numpy()
    size = np.diff(first)
    at = first[:-1] + anchor
    right = np.full((n, window), -1, np.int64)
    for t in range(window):
        ok = anchor + t < size
        right[ok, t] = ids[at[ok] + t]
    left = np.full((n, span - 1), -1, np.int64)
    for t in range(span - 1):
        ok = anchor - 1 - t >= 0
        left[ok, t] = ids[at[ok] - 1 - t]
    r, l = _tree_classes(right), _tree_classes(left)
    out = np.full((n, span), NONE, np.int64)
    for o in range(span):  # the window that starts o words left of the anchor
        ok = np.flatnonzero((o <= anchor) & (anchor - o + window <= size))
        if not len(ok):
            continue
        node = r[ok, window - o] * (n + 1) + l[ok, o]
        order = np.lexsort((least[ok], node))
        node, who = node[order], ok[order]
        head = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        low = np.repeat(least[who[head]], np.diff(np.r_[head, len(node)]))
        out[who, anchor[who] - o] = low
    return out


def _subtrees(window: int):
    """From (prefix, anchor, leaf, context, first_id, last_id) sorted by prefix: repeats of each leaf."""

    def flush(t: pa.Table) -> pa.RecordBatch:
        anchor, least, last = (t.column(c).to_numpy().astype(np.int64) for c in ("anchor", "first_id", "last_id"))
        low = _subtree(t.column("context").to_pylist(), anchor, least, window)
        hit = np.flatnonzero((low < last[:, None]).any(axis=1))
        held = low[hit]
        offsets = pa.array(np.arange(0, held.size + 1, held.shape[1]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(held.reshape(-1), pa.int64()))
        return pa.RecordBatch.from_arrays([t.column("leaf").combine_chunks().take(pa.array(hit, pa.int64())), lists], ["leaf", "first_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            now = batch.column("prefix")[-1].as_py()
            if size >= 40_000 and held[0].column("prefix")[0].as_py() != now:
                t = pa.Table.from_batches(held)
                changed = np.flatnonzero(pc.not_equal(t.column("prefix"), pa.scalar(now, pa.binary())).to_numpy())
                cut = int(changed[-1]) + 1
                yield flush(t.slice(0, cut))
                rest = t.slice(cut).combine_chunks()
                held, size = rest.to_batches(), rest.num_rows
        if size:
            yield flush(pa.Table.from_batches(held))

    return run


def _removed(n: int, full: bool, words: list[int], masks: list[int], window: int) -> np.ndarray:
    gone = np.zeros(n + 1, np.int64)
    if full:
        return np.ones(n, bool) if n >= window else np.zeros(n, bool)
    if words:
        w, m = np.array(words), np.array(masks)
        for b in range(window - GRAM + 1):
            at = w[(m >> b) & 1 == 1] + b
            np.add.at(gone, at, 1)
            np.add.at(gone, np.minimum(at + window, n), -1)
    return np.cumsum(gone[:n]) > 0


def _apply(window: int):
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string(), "spans": pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if not c.startswith("_ss_")]
            for i, j, buf, off in TK.text_slices(batch.column("_ss_text")):
                out: dict[str, list] = {c: [] for c in kinds}
                full, words, masks = (batch.column(c).slice(i, j - i).to_pylist() for c in ("_ss_full", "_ss_words", "_ss_masks"))
                start, end, first = TK.words(buf, off)
                joined, pos = TK.joined(buf, start, end)
                raw = joined.tobytes()
                for k in range(j - i):
                    a, b = int(first[k]), int(first[k + 1])
                    gone = _removed(b - a, bool(full[k]), words[k] or [], masks[k] or [], window)
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                    spans = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                    keep, at = [], 0
                    for x, y in [*spans, (b - a, b - a)]:
                        if x > at:
                            keep.append(raw[pos[a + at] : pos[a + x] - 1])
                        at = y
                    out["n_words"].append(b - a)
                    out["n_removed"].append(int(gone.sum()))
                    out["kept_text"].append(b" ".join(keep).decode())
                    out["spans"].append([{"first": x, "words": y - x} for x, y in spans])
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in names), *(pa.array(out[c], kinds[c]) for c in kinds)], [*names, *(f"_sub_{c}" for c in kinds)])

    return run


def repeat_starts(spark: SparkSession, docs: DataFrame, window: int = WINDOW, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """(doc_id, text_key, full, words, masks): for each text that loses words, either ``full`` (an equal text
    stands in a smaller document), or the words at which its leaves start and for each a bit mask of the
    leaf's windows that also start in a smaller document."""
    if window < GRAM + 1:
        raise ValueError(f"window must be over {GRAM}")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    keyed = base.select("doc_id", F.unhex(F.md5("text")).alias("text_key"), "text")

    census = base.mapInArrow(TK.tidied(_census(window)), "gram long, doc_id long")
    shared = census.groupBy("gram").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("gram")
    # a table of its own, so that the join's two sides are plain exchanges and a hot gram can be split
    shared = saved(spark, shared, "substring-shared")
    wanted = saved(spark, census.join(shared, "gram").groupBy("doc_id").agg(F.collect_list("gram").alias("grams")), "substring-census")

    ids = keyed.select("doc_id", "text_key")
    firsts = ids.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    copies = saved(spark, ids.join(firsts, "text_key").where("doc_id > first_id").select("doc_id", "text_key").distinct(), "substring-copies")

    todo = wanted.join(ids.distinct(), "doc_id").join(copies, ["doc_id", "text_key"], "left_anti")
    distinct = keyed.join(todo, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "grams")
    found = distinct.mapInArrow(TK.tidied(_contexts(window)), "doc_id long, text_key binary, word long, anchor int, context binary, prefix binary")
    found = saved(spark, found.withColumn("leaf", F.unhex(F.md5("context"))), "substring-contexts")

    leaves = found.groupBy("leaf", "anchor", "context", "prefix").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    leaves = saved(spark, leaves, "substring-leaves")
    heavy = leaves.groupBy("prefix").count().where(F.col("count") > max_leaves).select("prefix")
    heavy = saved(spark, heavy, "substring-heavy")
    light = leaves.join(heavy, "prefix", "left_anti").repartitionByRange("prefix").sortWithinPartitions("prefix")
    nodes = light.select("prefix", "anchor", "leaf", "context", "first_id", "last_id").mapInArrow(TK.tidied(_subtrees(window)), "leaf binary, first_ids array<long>")
    if not heavy.isEmpty():
        nodes = nodes.unionByName(_deep(leaves.join(heavy, "prefix", "left_semi"), window))

    hits = found.select("leaf", "doc_id", "text_key", "word").join(nodes, "leaf")
    bit = F.transform("first_ids", lambda m, k: F.when(m < F.col("doc_id"), F.call_function("shiftleft", F.lit(1), k)).otherwise(0))
    hits = hits.select("doc_id", "text_key", "word", F.aggregate(bit, F.lit(0), lambda a, x: a + x).alias("mask")).where("mask > 0")
    spans = hits.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("word", "mask")).alias("at"))
    spans = spans.select("doc_id", "text_key", F.lit(False).alias("full"), F.col("at.word").alias("words"), F.col("at.mask").alias("masks"))
    spans = saved(spark, spans, "substring-spans")
    discard(spark, shared, wanted, found, leaves, heavy)
    empty = [F.lit(None).cast(t) for t in ("array<long>", "array<int>")]
    return spans.unionByName(copies.select("doc_id", "text_key", F.lit(True).alias("full"), empty[0].alias("words"), empty[1].alias("masks")))


def _deep(leaves: DataFrame, window: int) -> DataFrame:
    """Too frequent prefixes, extended to the whole window: each window is a leaf, merged by aggregation."""
    words = F.split(F.col("context").cast("string"), " ")
    each = leaves.select("leaf", "anchor", "first_id", words.alias("w"))
    each = each.select("leaf", "anchor", "first_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("w") - window), lambda i: F.array_join(F.slice("w", i + 1, window), " "))).alias("k", "passage"))
    low = each.groupBy("passage").agg(F.min("first_id").alias("low"))
    back = each.join(low, "passage").groupBy("leaf", "anchor").agg(F.array_sort(F.collect_list(F.struct("k", "low"))).alias("at"))
    return back.select("leaf", F.col("at.low").alias("first_ids"))


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``docs`` with four more columns: _sub_n_words, _sub_n_removed, _sub_kept_text (the kept words joined by
    one space) and _sub_spans (the maximal repeats removed: first word and number of words)."""
    starts = repeat_starts(spark, docs, window, max_leaves)
    starts = starts.select(F.col("doc_id").alias("_ss_id"), F.col("text_key").alias("_ss_key"), F.col("full").alias("_ss_full"), F.col("words").alias("_ss_words"), F.col("masks").alias("_ss_masks"))
    text = F.col("text").cast("string")
    rows = docs.withColumns({"_ss_text": text, "_ss_row_id": F.col("doc_id").cast("long"), "_ss_row_key": F.unhex(F.md5(text))})
    rows = rows.join(starts, (F.col("_ss_row_id") == F.col("_ss_id")) & (F.col("_ss_row_key") == F.col("_ss_key")), "left").drop("_ss_id", "_ss_key", "_ss_row_id", "_ss_row_key")
    more = T._parse_datatype_string("_sub_n_words long, _sub_n_removed long, _sub_kept_text string, _sub_spans array<struct<first:long,words:long>>")
    return rows.mapInArrow(TK.tidied(_apply(window)), T.StructType([*docs.schema.fields, *more.fields]))
