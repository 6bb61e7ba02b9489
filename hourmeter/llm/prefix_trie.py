"""Conversation prefix trie by fixed-length block hashing.

A node is a distinct sequence of a conversation's first d turns; its members are the conversations that start
with it.  The trie is built from blocks of ``BLOCK`` turns:

1. *Turns.*  Each turn becomes a 128-bit digest of role and text, numbered inside its conversation in slices,
   so that a very long conversation is not one task.
2. *Blocks.*  A turn's two 64-bit hashes are salted with its place; the XOR over a block is the block's hash,
   and the XOR over all blocks before it is the hash of the prefix it continues.  Blocks with the same prefix and the
   same hash are one variant: copies meet here, before the shuffle, as a count and a smallest conv_id.
3. *Refinement.*  Where one prefix is continued by one variant only, no sibling diverges inside the block, and
   its turns are nodes as they stand.  Only where several variants continue a prefix are their turns' own prefix
   hashes compared, one row for each variant and turn.
4. *Subtrees.*  No walk over the trie is needed.  A conversation represents a node if it is its smallest member;
   the turns that it shares with a smaller conversation are a prefix of it, with ``shared`` words.  Leaves below
   a node are its members that represent a leaf.  Tokens saved below a node of n members, at which ``before`` words
   stand above it, are the sum of its members' ``shared`` without its representative's, less (n - 1) * before.  Both
   sums follow the same blocks.
5. *Ends.*  The conv_ids that end at a node are joined in order: sorted runs become strings of bounded size in many
   tasks, and one stream of those strings is digested, never held together.

Hash collisions: two nodes are taken for one if 128 bits agree by chance; the hash isn't made against crafted texts.

Nulls: null roles and texts are empty, a null turn sorts first, and rows without conv_id belong to no conversation.
Rows that repeat (conv_id, turn) are turns of their own, in order of role and text digest.  Other columns are not
looked at.  An empty table has no conversation and so no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmeter.llm import textkernel as TK
from hourmeter.llm.frames import discard, saved
from hourmeter.operators.sliced import sliced_running_sum

BLOCK = 4
WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation that are numbered together, and blocks whose prefixes are folded together.
SLICE_TURNS, SLICE_BLOCKS = 4096, 1024
#: conv_ids of one string on the way to a node's digest.
END_IDS = 65_536

_ID = ["depth", "i1", "i2"]


def numbered(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words) of every turn of ``turns`` (conv_id, turn, role, text); pos counts from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    rows = saved(spark, rows, "trie-turns")
    # null turns come first: their slice lies below all others
    part = F.coalesce(F.floor(F.col("turn") / SLICE_TURNS), F.lit(-(1 << 62)))
    placed = sliced_running_sum(rows, ["conv_id"], ["turn", "role", "digest"], part, F.lit(1).cast("long"), "pos")
    out = saved(spark, placed.select("conv_id", "pos", "digest", "words"), "trie-numbered")
    discard(spark, rows)
    return out


def _xor(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), [F.coalesce(c, F.lit(0).cast("long")) for c in cols])


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """One row for each block of a conversation: the slots' hashes and words (a0, b0, w0, ...; null past the end), the
    prefix's hash q1, q2 and words qw before it, and the hash p1, p2 after it."""
    place = F.pmod(F.col("pos") - 1, F.lit(size))
    salted = turns.select(
        "conv_id",
        F.expr(f"(pos - 1) div {size}").alias("block"),
        place.alias("slot"),
        F.xxhash64("pos", "digest").alias("a"),
        F.xxhash64("digest", F.lit("second"), "pos").alias("b"),
        F.col("words").alias("w"),
    )
    slots = [F.max(F.when(F.col("slot") == s, F.col(c))).alias(f"{c}{s}") for s in range(size) for c in "abw"]
    blocks = salted.groupBy("conv_id", "block").agg(*slots)
    blocks = blocks.withColumns(
        {
            "part": F.expr(f"block div {SLICE_BLOCKS}"),
            "x1": _xor([F.col(f"a{s}") for s in range(size)]),
            "x2": _xor([F.col(f"b{s}") for s in range(size)]),
            "xw": sum((F.coalesce(f"w{s}", F.lit(0)) for s in range(1, size)), F.coalesce("w0", F.lit(0))),
        }
    )
    # running XOR inside a slice of blocks, then over the slices before it (only conversations of several slices have any)
    zero = F.lit(0).cast("long")
    before = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"q1": F.coalesce(F.bit_xor("x1").over(before), zero), "q2": F.coalesce(F.bit_xor("x2").over(before), zero), "qw": F.coalesce(F.sum("xw").over(before), zero)})
    longer = blocks.select("conv_id", "part", "block", "x1", "x2", "xw").join(blocks.where("part > 0").select("conv_id").distinct(), "conv_id", "left_semi")
    slices = longer.groupBy("conv_id", "part").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("xw").alias("xw"))
    ends = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("conv_id", "part", F.bit_xor("x1").over(ends).alias("s1"), F.bit_xor("x2").over(ends).alias("s2"), F.sum("xw").over(ends).alias("sw")).where("part > 0")
    blocks = blocks.join(slices, ["conv_id", "part"], "left")
    q1, q2 = _xor([F.col("q1"), F.col("s1")]), _xor([F.col("q2"), F.col("s2")])
    return blocks.select(
        "conv_id",
        "block",
        *[f"{c}{s}" for s in range(size) for c in "abw"],
        q1.alias("q1"),
        q2.alias("q2"),
        (F.col("qw") + F.coalesce("sw", zero)).alias("qw"),
        "xw",
        q1.bitwiseXOR(F.col("x1")).alias("p1"),
        q2.bitwiseXOR(F.col("x2")).alias("p2"),
    )


def _turns_of(variants: DataFrame, size: int, *more: str) -> DataFrame:
    """One row for each turn of each variant: depth, own and parent's hash, its words and those before it."""
    rows, a, b, before = [], F.col("q1"), F.col("q2"), F.col("qw")
    for s in range(size):
        up = (a, b)
        a, b = a.bitwiseXOR(F.col(f"a{s}")), b.bitwiseXOR(F.col(f"b{s}"))
        node = {"depth": F.col("block") * size + s + 1, "i1": a, "i2": b, "u1": up[0], "u2": up[1], "words": F.col(f"w{s}"), "before": before}
        rows.append(F.when(F.col(f"a{s}").isNotNull(), F.struct(*[v.cast("long").alias(k) for k, v in node.items()])))
        before = before + F.col(f"w{s}")
    turns = variants.select(*more, F.explode(F.array(*rows)).alias("t")).where("t is not null")
    return turns.select("t.*", *more)


def _end_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conv_id become strings of at most END_IDS ids of one node."""
    node, ids, out, held = None, [], [], 0

    def full() -> int:
        n = len(ids)
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
            ids.clear()
        return n

    def told() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())], [*_ID, "first", "ids"])

    for batch in batches:
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != node or len(ids) >= END_IDS:
                held += full()
                node = key
                if held >= END_IDS:
                    held = 0
                    yield told()
            ids.append(conv)
    full()
    if out:
        yield told()


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings sorted by node and first id are digested as they come; a node ends when the next begins."""
    node, digest, out = None, None, []

    def told() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*_ID, "ends_sha256"])

    for batch in batches:
        for d, i1, i2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (d, i1, i2) == node:
                digest.update(b",")
            else:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (d, i1, i2), hashlib.sha256()
            digest.update(ids.encode())
        if len(out) >= 4096:
            yield told()
    if node is not None:
        out.append((*node, digest.hexdigest()))
        yield told()


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, i1, i2, ends_sha256): digest of each node's conv_ids, ascending and joined by commas."""
    key = ", ".join(f"{c} long" for c in _ID)
    runs = ends.select(*_ID, "conv_id").repartitionByRange(*_ID, "conv_id").sortWithinPartitions(*_ID, "conv_id")
    strings = runs.mapInArrow(TK.tidied(_end_strings), f"{key}, first long, ids string")
    return strings.repartition(*_ID).sortWithinPartitions(*_ID, "first").mapInArrow(TK.tidied(_end_digests), f"{key}, ends_sha256 string")


def trie(spark: SparkSession, turns: DataFrame, convs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.  ``turns`` is a table like that of ``numbered``; ``convs`` has each conv_id
    once, those without turns included.  A node's last text is turn ``depth`` of ``conv_id``; see ``node_turns``."""
    convs = convs.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"))
    blocks = saved(spark, _blocks(turns, size), "trie-blocks")
    slots = [f"{c}{s}" for s in range(size) for c in "abw"]
    after = ["block", "p1", "p2"]
    same = [F.min(c).alias(c) for c in ("q1", "q2", "qw", *slots)]  # equal in all copies
    variants = blocks.groupBy(*after).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), *same)
    lone = variants.groupBy("block", "q1", "q2").agg(F.count(F.lit(1)).alias("m"), F.min("p1").alias("p1"), F.min("p2").alias("p2")).where("m = 1").select(*after, F.lit(True).alias("lone"))
    variants = saved(spark, variants.join(lone, after, "left").withColumn("lone", F.coalesce("lone", F.lit(False))), "trie-variants")

    node = [*_ID, "u1", "u2", "words", "before"]
    straight = _turns_of(variants.where("lone"), size, "n", "least")
    refined = _turns_of(variants.where("not lone"), size, "n", "least").groupBy(*node).agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    nodes = saved(spark, straight.unionByName(refined), "trie-nodes")

    above = nodes.where("depth > 1").select((F.col("depth") - 1).alias("depth"), F.col("u1").alias("i1"), F.col("u2").alias("i2"))
    children = above.groupBy(*_ID).agg(F.count(F.lit(1)).alias("n_children"))
    leaves = nodes.join(children, _ID, "left_anti").select(F.col("least").alias("conv_id"), F.lit(1).cast("long").alias("leaf"))
    # what a conversation shares ends above the first node that it represents; a copy represents none and shares all
    begins = nodes.groupBy(F.col("least").alias("conv_id")).agg(F.min_by("before", "depth").alias("own"))
    n_turns = sum((F.col(f"a{s}").isNotNull().cast("long") for s in range(1, size)), F.col("a0").isNotNull().cast("long"))
    last = {c: F.max_by(c, "block").alias(c) for c in ("p1", "p2")}
    per_conv = blocks.groupBy("conv_id").agg(F.sum("xw").alias("all_words"), F.sum(n_turns).alias("depth"), *last.values())
    per_conv = per_conv.join(begins, "conv_id", "left").join(leaves, "conv_id", "left")
    per_conv = saved(spark, per_conv.select("conv_id", F.coalesce("own", "all_words").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"), "depth", F.col("p1").alias("i1"), F.col("p2").alias("i2")), "trie-convs")

    # sums over the members, by the same blocks; the representative's own share is the one of the least conv_id
    sums = {"shared": F.sum("shared").alias("shared"), "leaf": F.sum("leaf").alias("leaf")}
    told = blocks.select("conv_id", *after).join(per_conv.select("conv_id", "shared", "leaf"), "conv_id")
    told = told.groupBy(*after).agg(*sums.values(), F.min_by("shared", "conv_id").alias("first"))
    told = variants.join(told, after)
    straight = _turns_of(told.where("lone"), size, "shared", "leaf", "first").select(*_ID, "shared", "leaf", "first")
    refined = _turns_of(told.where("not lone"), size, "shared", "leaf", "first", "least").groupBy(*_ID).agg(*sums.values(), F.min_by("first", "least").alias("first"))
    sums_of = straight.unionByName(refined.select(*_ID, "shared", "leaf", "first"))

    n_all, least = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()  # the root
    ends = convs.join(per_conv, "conv_id", "left").select(*[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _ID], "conv_id")
    digests = ends_digest(ends)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("i1").alias("u1"), F.col("i2").alias("u2"), F.col("least").alias("parent"))
    below = nodes.where("depth > 1").join(parents, ["depth", "u1", "u2"]).select(*_ID, "parent")
    top = nodes.where("depth = 1").select(*_ID, F.lit(least).cast("long").alias("parent"))
    out = nodes.join(below.unionByName(top), _ID).join(sums_of, _ID).join(children, _ID, "left")
    out = out.select(*_ID, F.col("least").alias("conv_id"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("leaf").alias("n_leaves"), (F.col("shared") - F.col("first") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"))
    summed = per_conv.agg(F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaf"), F.coalesce(F.sum("shared"), F.lit(0)).alias("shared"))
    tops = nodes.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"))
    zero = F.lit(0).cast("long")
    root = summed.crossJoin(tops).select(  # one row each
        *[zero.alias(c) for c in _ID],
        F.lit(least).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(n_all).cast("long").alias("n_convs"),
        "n_children",
        F.greatest("leaf", F.lit(1)).alias("n_leaves"),
        F.col("shared").alias("saved_tokens"),
    ).where(F.lit(n_all > 0))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    longs = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    out = out.unionByName(root).join(digests, _ID, "left").select(*[F.col(c).cast("long").alias(c) for c in longs], F.coalesce("ends_sha256", none).alias("ends_sha256"))
    out = saved(spark, out, "trie")
    discard(spark, blocks, variants, nodes, per_conv)
    return out


def prefix_trie(spark: SparkSession, turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """The trie of the conversations in ``turns`` (conv_id, turn, role, text)."""
    own = numbered(spark, turns)
    out = trie(spark, own, own.select("conv_id").distinct(), size)
    discard(spark, own)
    return out


def shared_heads(turns: DataFrame, every: int, heads: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on another's opening: conv_id c takes the first ``heads`` turns of conversation c - c % every
    in place of its own (all if that has fewer, none if there is none).  ``turns`` is a table like that of ``numbered``;
    returns the rebuilt turns, and every conv_id.  ``heads`` is an expression in conv_id, ``every`` at least 1."""
    convs = turns.select("conv_id").distinct().withColumns({"h": heads.cast("long"), "base": F.col("conv_id") - F.col("conv_id") % every})
    most = F.broadcast(convs.agg(F.max("h").alias("most")))  # one row
    opening = turns.where(F.col("conv_id") % every == 0).join(most, F.col("pos") <= F.col("most")).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    taken = convs.join(opening, "base").where("pos <= h").select("conv_id", "pos", "digest", "words")
    has = opening.groupBy("base").agg(F.count(F.lit(1)).alias("n_base"))
    moved = convs.join(has, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("m"))
    rest = turns.join(moved, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "words")
    return taken.unionByName(rest), convs.select("conv_id")


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the digest and words of their last turn, from the numbered turns that the trie was built of."""
    return nodes.join(turns.select("conv_id", F.col("pos").alias("depth"), "digest", "words"), ["conv_id", "depth"], "left")
