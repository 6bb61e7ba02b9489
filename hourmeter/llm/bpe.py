"""Byte-level BPE encoding and decoding over overlapping chunks.

Where a pattern's next match begins depends only on the text from there on.  So two pre-tokenisations of one text,
begun at different places, agree from the first boundary that they share.  Long texts are sent out as chunks of
``chunk_chars``, each with ``overlap_chars`` more characters of the next one, which begins wherever it falls.  A
chunk is pre-tokenised from its own first character, and the overlap once more from the next chunk's; the
first common boundary is where the two are stitched.  Each chunk encodes its pre-tokens up to there, and drops
those before the place where it was met.  Boundaries that a chunk's end could change are not used: those from the
last pre-token with a character that isn't blank on, and the last ``_AHEAD`` characters before the blanks.  Two chunks
without a common boundary (a pre-token longer than the overlap) are encoded together, with as many of their
successors as it takes; others stay apart.  Texts up to ``chunk_chars`` are one chunk and are encoded where they are
read, without a shuffle.  Decoding concatenates the ids' raw bytes.

The pattern must not look behind, nor more than ``_AHEAD`` characters ahead of a run of one kind (letters, digits, blanks,
others).

Nulls: a null text is encoded as empty (no ids, no bytes).  A null doc_id keeps its row.  Repeated rows each
get a row.  An empty table gives an empty result.  Special tokens are never produced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
import tiktoken.registry
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmeter.llm import textkernel as TK

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 2_048
_AHEAD = 8
_IDS = pa.list_(pa.int32())
_FLUSH = 4 << 20


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, built once in each Python process."""
    known = tiktoken.registry.ENCODINGS
    name = f"ranks:{path}:{pattern}"
    if name not in known:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        known[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return known[name]


def _short(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            doc, ids, raw, size, at = [], [], [], 0, 0
            for k, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                ids.append(enc.encode_ordinary(text))
                raw.append(enc.decode_bytes(ids[-1]))
                size += len(text)
                if size >= _FLUSH or k + 1 == batch.num_rows:
                    doc = batch.column(0).slice(at, k + 1 - at)
                    yield pa.RecordBatch.from_arrays([doc, pa.array(ids, _IDS), pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"])
                    ids, raw, size, at = [], [], 0, k + 1

    return run


def _pieces(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py()
                n = -(-len(text) // chunk)
                for k in range(0, n, 64):
                    own = [text[p * chunk : (p + 1) * chunk + overlap] for p in range(k, min(n, k + 64))]
                    same = [pa.array([batch.column(c)[row].as_py()] * len(own), batch.column(c).type) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(range(k, k + len(own)), pa.int32()), pa.array([n] * len(own), pa.int32()), pa.array(own)], ["doc_id", "key", "piece", "n_pieces", "text"])

    return run


def boundaries(pattern: regex.Pattern, text: str, whole: bool) -> list[int]:
    """Where pre-tokens of ``text`` end; unless it is ``whole``, only those that more text wouldn't change."""
    spans = [m.span() for m in pattern.finditer(text)]
    if whole:
        return [b for _, b in spans]
    body = len(text.rstrip())
    sure = min(max((a for a, _ in spans if a < body), default=-1), body - _AHEAD)
    return [b for _, b in spans if b <= sure]


def encode_chunk(enc: tiktoken.Encoding, pattern: regex.Pattern, text: str, chunk: int, overlap: int, last: bool) -> dict:
    """ids of a chunk up to ``stop``, the boundary that it shares with the next one (-1: none in the overlap; not
    after a blank, which would be matched otherwise at a text's end), and how many ids precede each boundary (``head``) at which the chunk before may meet it."""
    own = [0, *boundaries(pattern, text, last)]
    if last:
        stop = len(text)
    else:
        of_next = {chunk, *(chunk + b for b in boundaries(pattern, text[chunk:], False))}
        stop = next((b for b in own if b >= chunk and b in of_next and not text[b - 1].isspace()), -1)
    if stop < 0:
        return {"ids": [], "stop": -1, "head": [], "before": []}
    head = [b for b in own if b <= min(stop, overlap)]
    ids, before = [], []
    for a, b in zip(head, [*head[1:], stop], strict=True):
        before.append(len(ids))
        ids += enc.encode_ordinary(text[a:b])
    return {"ids": ids, "stop": stop, "head": head, "before": before}


def join_chunks(enc: tiktoken.Encoding, pattern: regex.Pattern, rows: list[dict], chunk: int, overlap: int) -> tuple[list[int], int]:
    """(ids of the text, how many chunks had to be encoded together) from its chunks in order."""
    ids, start, k, together = [], 0, 0, 0
    while k < len(rows):
        row = rows[k]
        if row["stop"] >= 0 and start in row["head"]:
            ids += row["ids"][row["before"][row["head"].index(start)] :]
            start, k = row["stop"] - chunk, k + 1
            continue
        first, parts, met = k, [row["text"][start:]], False
        while not met and k + 1 < len(rows):
            at = (k - first) * chunk + rows[k]["stop"] - start
            if rows[k]["stop"] >= 0:
                text = "".join(parts) + rows[k + 1]["text"][:overlap]
                met = at in boundaries(pattern, text, False)
            if not met:
                k += 1
                parts.append(rows[k]["text"])
        ids += enc.encode_ordinary(text[:at] if met else "".join(parts))
        together += k + 1 - first
        start, k = rows[k]["stop"] - chunk, k + 1
    return ids, together


_PARTS = "doc_id long, key binary, piece int, copies long, text string, ids array<int>, stop int, head array<int>, before array<int>"


def _encode_pieces(path: str, pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, compiled = encoding(path, pattern), regex.compile(pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("piece", pa.int32()), ("copies", pa.int64()), ("text", pa.string()), ("ids", _IDS), ("stop", pa.int32()), ("head", _IDS), ("before", _IDS)])
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                got = encode_chunk(enc, compiled, row["text"], chunk, overlap, row["piece"] + 1 == row["n_pieces"])
                out.append({**{c: row[c] for c in ("doc_id", "key", "piece", "copies")}, "text": row["text"][:chunk], **got})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _stitch(path: str, pattern: str, chunk: int, overlap: int):
    def run(table: pa.Table) -> pa.Table:
        enc = encoding(path, pattern)
        ids, _ = join_chunks(enc, regex.compile(pattern), sorted(table.to_pylist(), key=lambda r: r["piece"]), chunk, overlap)
        return pa.table({"doc_id": table.column("doc_id").slice(0, 1), "copies": table.column("copies").slice(0, 1), "ids": pa.array([ids], _IDS), "decoded": pa.array([enc.decode_bytes(ids)], pa.binary())})

    return run


def encode(docs: DataFrame, path: str, pattern: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) for every row of ``docs``.  ``path`` is a rank file that every
    executor can open, ``pattern`` splits a text into pre-tokens."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long_text: Column = F.length("text") > chunk_chars
    short = base.where(~long_text).mapInArrow(TK.tidied(_short(path, pattern)), "doc_id long, ids array<int>, decoded binary")
    cut = base.where(long_text).select("doc_id", F.unhex(F.md5("text")).alias("key"), "text")
    pieces = cut.mapInArrow(TK.tidied(_pieces(chunk_chars, overlap_chars)), "doc_id long, key binary, piece int, n_pieces int, text string")
    pieces = pieces.groupBy("doc_id", "key", "piece", "n_pieces", "text").agg(F.count(F.lit(1)).alias("copies"))
    parts = pieces.mapInArrow(TK.tidied(_encode_pieces(path, pattern, chunk_chars, overlap_chars)), _PARTS)
    whole = parts.groupBy("doc_id", "key").applyInArrow(_stitch(path, pattern, chunk_chars, overlap_chars), "doc_id long, copies long, ids array<int>, decoded binary")
    whole = whole.select("doc_id", "ids", "decoded", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
    return short.unionByName(whole)
