"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both token sequences of a text tile the same bytes.  A *link* is a pair of tokens whose byte ranges overlap; a
*group* is a smallest run of tokens that both tokenizers end at the same byte.  Groups are found by pointer jumping:
every token points to the overlapping token that reaches farthest right (itself if none reaches farther), and
all pointers are doubled at once until they stand still; the token that a pointer ends at is the last of its
group and labels it.  All texts of a slice are laid end to end, as a text's end is always a common end.

An id pair counts once for each row that holds it linked.  Counts cover all rows, by blocks: a task encodes
about ``BLOCK_PAIRS`` pairs of consecutive rows into one block, which names its distinct pairs once and keeps the rows' pairs
as places in that list, packed.  Only the lists are aggregated and joined with their totals; a pair of every text is
as many rows as there are blocks, not texts.  Totals come back to their block, where the rows' sums are taken.
The task that reads a block holds that block and nothing else of its size, unless one text alone is larger.

Files of both vocabularies must open on every executor.

Nulls: a null or empty text, or one of which a tokenizer doesn't give back all bytes, has no tokens: zeros and no
groups.  A null doc_id keeps its row.  Repeated rows each get a row and each count.  Other columns are not looked at.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.llm import textkernel as TK
from hourmeter.llm.frames import discard, saved

BLOCK_PAIRS = 500_000
SLICE_BYTES = 1 << 18
#: Fixed value: how byte-level files split a text into pre-tokens.
_GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass
class Vocabulary:
    """Every id's bytes, one after the other, and where each begins."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        at = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=at[1:])
        return cls(np.frombuffer(b"".join(tokens), np.uint8), at)

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined bytes of ``ids``, and each one's length."""
        size = self.at[ids + 1] - self.at[ids]
        begin = np.cumsum(size) - size
        return self.data[np.repeat(self.at[ids] - begin, size) + np.arange(int(size.sum()))], size


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes stand for themselves, the
    others are numbered from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file of the tokenizers library.  Where its merges make ids in order, as byte-level files do, they
    are ranks, and the faster library encodes by them; any other file is encoded by its own library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_of_character()
        special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
        named = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        tokens = [b""] * (max(named.values()) + 1)
        for name, k in named.items():
            tokens[k] = name.encode() if name in special else bytes(byte[c] for c in name)
        self.vocabulary = Vocabulary.of(tokens)
        ranks = {tokens[k]: k for name, k in spec["model"]["vocab"].items() if name not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in merges]
        ordered = made == sorted(set(made)) and len(ranks) == 256 + len(made) and max(ranks[bytes([b])] for b in range(256)) < min(made)
        pre, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and normal is None and not spec["model"].get("ignore_merges")
        self.by_rank = self.own = None
        if ordered and plain:
            self.by_rank = tiktoken.Encoding(path, pat_str=_GPT2_PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            import tokenizers

            self.own = tokenizers.Tokenizer.from_file(path)
            self.own.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.by_rank is not None:
            return [self.by_rank.encode_ordinary(t) for t in texts]
        return [self.own.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """A sentencepiece model with byte fallback."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        names = self.model.id_to_piece(list(ids))
        self.vocabulary = Vocabulary.of([bytes([int(n[3:5], 16)]) if self.model.is_byte(k) else n.replace("▁", " ").encode() for k, n in zip(ids, names, strict=True)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_OPEN: dict[tuple[type, str], ByteLevel | Pieces] = {}


def opened(kind: type, path: str) -> ByteLevel | Pieces:
    """A tokenizer, read once in each Python process."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]


def group_labels(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number, from 0 in text order, of every token of both sequences, given where tokens end."""
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)  # the token of the other sequence that covers a token's last byte
    over_b = np.searchsorted(end_a, end_b)
    own = np.arange(n + len(end_b))
    to = own.copy()
    to[:n] = n + over_a
    to[n:] = np.where(end_a[over_b] > end_b, over_b, own[n:])
    while True:
        twice = to[to]
        if np.array_equal(twice, to):
            break
        to = twice
    number = np.cumsum(to == own) - 1
    return number[to[:n]], number[to[n:]]


def links_of(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sequences of every pair of overlapping tokens."""
    begin_a = np.concatenate([[0], end_a[:-1]])
    low = np.searchsorted(end_b, begin_a, "right")
    n = np.searchsorted(end_b, end_a) - low + 1
    left = np.repeat(np.arange(len(end_a)), n)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def _written(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All groups as ``a1,a2|b1;``..., and where in that each a and b token's text ends."""
    n, m = len(ids_a), len(ids_b)
    place_a = np.arange(n) + np.searchsorted(group_b, group_a)
    place_b = np.arange(m) + np.searchsorted(group_a, group_b, "right")
    ids, mark = np.empty(n + m, np.int64), np.empty(n + m, np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark[place_a] = np.where(np.append(group_a[1:] != group_a[:-1], True), ord("|"), ord(","))
    mark[place_b] = np.where(np.append(group_b[1:] != group_b[:-1], True), ord(";"), ord(","))
    digits = np.ones(n + m, np.int64)
    top = 10
    while (more := ids >= top).any():
        digits += more
        top *= 10
    stop = np.cumsum(digits + 1)
    out = np.empty(int(stop[-1]) if n + m else 0, np.uint8)
    out[stop - 1] = mark
    rest, k, live = ids, 2, np.arange(n + m)
    while len(live):
        out[stop[live] - k] = 48 + rest % 10
        rest, k = rest // 10, k + 1
        go = digits[live] >= k - 1
        live, rest = live[go], rest[go]
    return out, stop[place_a], stop[place_b]


def _laid(texts: list[str], ids: list[list[int]], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, their lengths in bytes, each text's number of tokens, and whether it reads as the text."""
    flat = np.fromiter((i for x in ids for i in x), np.int64, sum(map(len, ids)))
    count = np.array([len(x) for x in ids], np.int64)
    spelled, size = vocabulary.spell(flat)
    first = np.concatenate([[0], np.cumsum(count)])
    byte_at = np.concatenate([[0], np.cumsum(size)])[first]
    same = np.array([spelled[a:b].tobytes() == t.encode() for t, a, b in zip(texts, byte_at[:-1].tolist(), byte_at[1:].tolist(), strict=True)], bool)
    return flat, size, count, same


_ROW = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


@dataclass
class _Slice:
    """What one slice of rows leaves behind: counts a row, and each row's distinct pairs with how often they stand there."""

    rows: dict[str, list]
    pairs: np.ndarray
    times: np.ndarray
    n_pairs: np.ndarray


def aligned(texts: list[str | None], a: ByteLevel, b: Pieces) -> _Slice:
    """Encode and align texts; a space stands before each."""
    n = len(texts)
    asked = [k for k, t in enumerate(texts) if t]
    spaced = [" " + texts[k] for k in asked]
    flat_a, size_a, count_a, same_a = _laid(spaced, a.encode(spaced), a.vocabulary)
    flat_b, size_b, count_b, same_b = _laid(spaced, b.encode([texts[k] for k in asked]), b.vocabulary)
    good = same_a & same_b
    keep_a, keep_b = np.repeat(good, count_a), np.repeat(good, count_b)
    flat_a, flat_b, size_a, size_b = flat_a[keep_a], flat_b[keep_b], size_a[keep_a], size_b[keep_b]
    row = np.array(asked, np.int64)[good]
    count_a, count_b = count_a[good], count_b[good]
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    group_a, group_b = group_labels(end_a, end_b)
    left, right = links_of(end_a, end_b)
    told, _, stop_b = _written(flat_a, flat_b, group_a, group_b)
    rows = {"n_a": np.zeros(n, np.int64), "n_b": np.zeros(n, np.int64), "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64)}
    last_b = np.cumsum(count_b) - 1
    rows["n_a"][row], rows["n_b"][row] = count_a, count_b
    rows["n_groups"][row] = np.diff(group_b[last_b], prepend=-1)
    text_of = np.repeat(np.arange(len(row)), count_a)[left]
    rows["n_links"][row] = np.bincount(text_of, minlength=len(row))
    sha = [""] * n
    begin = 0
    for k, stop in zip(row.tolist(), stop_b[last_b].tolist(), strict=True):
        sha[k] = hashlib.sha256(told[begin : stop - 1].tobytes()).hexdigest()  # without the last separator
        begin = stop
    pair = flat_a[left] << 32 | flat_b[right]
    order = np.lexsort((pair, text_of))
    pair, text_of = pair[order], text_of[order]
    new = np.append(True, (pair[1:] != pair[:-1]) | (text_of[1:] != text_of[:-1])) if len(pair) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    n_pairs = np.zeros(n, np.int64)
    n_pairs[row] = np.bincount(text_of[at], minlength=len(row))
    return _Slice({**rows, "groups_sha256": sha}, pair[at], np.diff(np.append(at, len(pair))).astype(np.int32), n_pairs)


_BLOCK = pa.schema([("block", pa.int64()), *((c, pa.list_(pa.string() if c == "groups_sha256" else pa.int64())) for c in _ROW), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())), ("packed", pa.binary())])
_BLOCK_SQL = "block long, " + ", ".join(f"{c} array<{'string' if c == 'groups_sha256' else 'long'}>" for c in _ROW) + ", pairs array<long>, held array<int>, packed binary"


def _blocks(kind_a: type, path_a: str, kind_b: type, path_b: str, block_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = opened(kind_a, path_a), opened(kind_b, path_b)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[list, _Slice]] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            rows = {"doc_id": [d for ids, _ in held for d in ids]}
            for c in _ROW[1:]:
                rows[c] = [x for _, s in held for x in (s.rows[c] if c == "groups_sha256" else s.rows[c].tolist())]
            names, place, count = np.unique(np.concatenate([s.pairs for _, s in held]), return_inverse=True, return_counts=True)
            times, n_pairs = (np.concatenate([getattr(s, f) for _, s in held]) for f in ("times", "n_pairs"))
            first = np.zeros(len(place), bool)
            first[(np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]] = True
            step = np.diff(place, prepend=0)  # a row's places ascend: small steps pack well
            step[first] = place[first]
            packed = pa.compress(np.concatenate([n_pairs, step, times]).astype("<i4").tobytes(), "zstd", asbytes=True)
            head = np.array([len(rows["doc_id"]), len(place)], "<i8").tobytes()
            out = pa.RecordBatch.from_pylist([{"block": number, **rows, "pairs": names, "held": count.astype(np.int32), "packed": head + packed}], _BLOCK)
            number += 1
            held.clear()
            return out

        waiting = 0
        for batch in batches:
            for i, j in TK.slices(TK.utf8(batch.column(1))[1], SLICE_BYTES):
                part = aligned(batch.column(1).slice(i, j - i).to_pylist(), a, b)
                held.append((batch.column(0).slice(i, j - i).to_pylist(), part))
                waiting += len(part.pairs)
                if waiting >= block_pairs:
                    yield block()
                    waiting = 0
        if held:
            yield block()

    return run


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _sums(key, block: pa.Table, totals: pa.Table) -> pa.Table:
    """One block's rows, with the totals of its pairs."""
    order = np.argsort(totals.column("place").to_numpy())
    total, best = totals.column("total").to_numpy()[order], totals.column("best").to_numpy(zero_copy_only=False)[order]
    told = block.column("packed")[0].as_py()
    n, m = np.frombuffer(told[:16], "<i8").tolist()
    flat = np.frombuffer(pa.decompress(told[16:], (n + 2 * m) * 4, "zstd"), "<i4").astype(np.int64)
    n_pairs, step, times = flat[:n], flat[n : n + m], flat[n + m :]
    row = np.repeat(np.arange(n), n_pairs)
    run = np.cumsum(step)
    base = np.concatenate([[0], run])[np.cumsum(n_pairs) - n_pairs]
    place = run - base[row]
    count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(count_sum, row, times * total[place])
    np.add.at(n_best, row, times * best[place])
    out = {c: pa.concat_arrays([block.column(c)[0].values]) for c in _ROW}
    return pa.table({**{c: out[c] for c in _ROW[:5]}, "n_best": n_best, "count_sum": count_sum, "groups_sha256": out["groups_sha256"]})


def align(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, kind_a: type = ByteLevel, kind_b: type = Pieces, block_pairs: int = BLOCK_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Both results over all rows of ``docs`` (doc_id, text): one row each with its numbers of tokens, groups and links,
    the links whose pair is the most frequent of its a id (n_best), the sum of the links' counts and the groups'
    digest; and the pair table (a, b, n_rows, best), the corpus-wide alignment of both vocabularies."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = saved(spark, rows.mapInArrow(TK.tidied(_blocks(kind_a, path_a, kind_b, path_b, block_pairs)), _BLOCK_SQL), "align-blocks")
    named = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "p")).select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.held").cast("long").alias("held"))
    counts = named.groupBy("pair").agg(F.sum("held").alias("total")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("total").alias("most"))
    pairs = saved(spark, counts.join(highest, "a").select("pair", "a", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "total", (F.col("total") == F.col("most")).alias("best")), "align-pairs")
    totals = named.select("block", "place", "pair").join(pairs.select("pair", "total", "best"), "pair").select(F.col("block").alias("of_block"), "place", "total", "best")
    out = blocks.drop("pairs", "held").groupBy("block").cogroup(totals.groupBy("of_block")).applyInArrow(_sums, _OUT)
    out = saved(spark, out, "align")
    discard(spark, blocks)
    return out, pairs.select("a", "b", F.col("total").alias("n_rows"), "best")
