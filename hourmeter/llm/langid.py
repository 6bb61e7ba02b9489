"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are character n-grams (one to three characters, lower-cased) hashed to ``BINS`` bins an order; a
feature's value is its share of the text's n-grams times its inverse document frequency, scaled.  Inverse
document frequencies are counted over all training documents.  The weights are fitted by
follow-the-regularised-leader with an elastic net on at most ``per_language`` documents of each language, and
``SAMPLE`` documents in all but ten a language at least (documented parameters; they bound the task that fits them).
The sample is the least hash of (doc_id, text) in each of so many buckets a language, so the bound holds however often
an id or a row repeats.  A fifth of it is held back, and the temperature that minimises their log loss calibrates the
probabilities.

Up to ``GROUP`` languages are one model.  More are cut into groups of that many, by name: one model tells the group, one in
each group, fitted in a task of its own, tells the language, and the probability is the product of both.

The score is linear in the n-grams, so a prediction is one pass over the whole text, however long.

Nulls: a null text, or one without letters, is ``und`` with score 0.  Rows without language don't train.
Repeated rows train once.  A null doc_id keeps its row and is never held
out.  Without any training row every text is ``und``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmeter.llm import textkernel as TK
from hourmeter.llm.frames import discard, saved

ORDERS = (1, 2, 3)
BINS = 1 << 14
PER_LANGUAGE = 1_500
SAMPLE = 6_000
GROUP = 256
SCALE = 16.0
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.2, 0.02
SLICE_CHARS = 1 << 19
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (bins of all orders, languages), inverse document frequency and scale included
    bias: np.ndarray
    temperature: float
    parts: list[Model] | None = None  # the languages are numbers of groups then, and this has the groups' models


def _codes(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """For slices of a text column, lower-cased: first and end text, each order's bin at every character, and character offsets.
    The last order - 1 positions of a text run over into the next; their bins are the number of all bins."""
    for i, j in TK.slices(TK.utf8(column)[1], SLICE_CHARS):
        own = [f" {(t or '').lower()} " for t in column.slice(i, j - i).to_pylist()]
        off = np.zeros(len(own) + 1, np.int64)
        np.cumsum([len(t) for t in own], out=off[1:])
        c = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
        out = []
        for order, n in enumerate(ORDERS):
            h = c * np.uint32(2654435761)
            for t in range(1, n):
                h[:-t] = (h[:-t] ^ (h[:-t] >> np.uint32(15))) * np.uint32(2246822519) + c[t:] * np.uint32(3266489917)
            h ^= h >> np.uint32(13)
            h *= np.uint32(2654435769)
            code = (h >> np.uint32(32 - BINS.bit_length() + 1)).astype(np.int32) + order * BINS
            for t in range(1, n):
                code[np.maximum(off[1:] - t, 0)] = len(ORDERS) * BINS
            out.append(code)
        yield i, j, out, off


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = len(ORDERS) * BINS + 1
    seen, total, docs = np.zeros(size, bool), np.zeros(size, np.int64), 0
    for batch in batches:
        for _, _, codes, off in _codes(batch.column(0)):
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                seen[:] = False
                for code in codes:
                    seen[code[a:b]] = True
                total += seen
                docs += 1
    if docs:
        total[-1] = docs
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bin", "n"])


def _rows(texts: pa.Array, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, _, codes, off in _codes(texts):
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            found = [np.unique(code[a:b], return_counts=True) for code in codes]
            at = np.concatenate([x for x, _ in found])
            value = np.concatenate([n / (b - a) for _, n in found])
            live = at < len(idf)
            at, value = at[live], value[live]
            live = idf[at] > 0
            out.append((at[live], value[live] * idf[at[live]] * SCALE))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, k: int, dims: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader, one example after the other, rates by coordinate; (weights, bias)."""
    z, n = np.zeros((dims + 1, k)), np.zeros((dims + 1, k))  # the last row is the bias, which is not shrunk

    def solved(at: np.ndarray) -> np.ndarray:
        zz, nn = z[at], n[at]
        l1 = np.where(at == dims, 0.0, L1)[:, None]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in order:
            at, x = np.append(rows[i][0], dims), np.append(rows[i][1], 1.0)
            w = solved(at)
            p = _softmax(x @ w)
            p[label[i]] -= 1.0
            g = np.outer(x, p)
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - s * w
            n[at] += g * g
    w = solved(np.arange(dims + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(_softmax(logits / np.exp(t))[np.arange(len(label)), label] + 1e-12).mean())

    lo, hi, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _fit(idf: np.ndarray, languages: list[list[str]]):
    """Fit the rows (group, text, label, draw) of one group, whose labels ``languages[group]`` lists."""

    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        place = {x: k for k, x in enumerate(languages[group])}
        draw = table.column("draw").to_numpy()
        order = np.argsort(draw, kind="stable")
        label = np.array([place[x] for x in table.column("label").to_pylist()])
        rows = _rows(TK.one_array(table.column("text")), idf)
        held = np.zeros(len(rows), bool)
        held[order[::5]] = len(rows) >= 50
        w, b = fit_rows(rows, label, len(place), len(idf), order[~held[order]])
        logits = np.array([x @ w[at] + b for i, (at, x) in enumerate(rows) if held[i]]).reshape(-1, len(place))
        t = fit_temperature(logits, label[held])
        w = (w * idf[:, None] * SCALE).astype("<f8")
        return pa.table({"group": pa.array([group], pa.int32()), "weights": pa.array([w.tobytes()], pa.binary()), "bias": pa.array([b.astype("<f8").tobytes()], pa.binary()), "temperature": [t]})

    return run


def _sample(rows: DataFrame, label: str, n: int, more: str) -> DataFrame:
    """At most ``n`` different rows of each label: the least draw in each of ``n`` buckets.  ``more`` names what is kept.
    The chosen draws are broadcast, as there are no more of them than the sample's bound."""
    bucket = F.pmod(F.xxhash64("draw", F.lit("bucket")), F.lit(n))
    chosen = rows.groupBy(label, bucket.alias("bucket")).agg(F.min("draw").alias("draw")).select(label, "draw")
    return rows.join(F.broadcast(chosen), [label, "draw"], "left_semi").dropDuplicates([label, "draw"]).select("text", "lang", "draw", more)


def _models(sample: DataFrame, idf: np.ndarray, languages: list[list[str]]) -> list[Model]:
    """The models of the groups in ``sample`` (group, label, text, draw); their number is bounded by the languages."""
    fitted = sample.groupBy("group").applyInArrow(_fit(idf, languages), "group int, weights binary, bias binary, temperature double").collect()
    of = {r["group"]: r for r in fitted}
    return [Model(x, np.frombuffer(of[g]["weights"], "<f8").reshape(len(idf), len(x)), np.frombuffer(of[g]["bias"], "<f8"), of[g]["temperature"]) for g, x in enumerate(languages)]


def train(spark: SparkSession, docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on the rows of ``docs`` (doc_id, text, lang) for which ``usable`` holds and lang is not null."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())  # the model has a column for each anyway
    if not names:
        return None
    dims = len(ORDERS) * BINS
    counts = rows.select("text").mapInArrow(TK.tidied(_document_counts), "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    df = np.zeros(dims + 1)
    for r in counts.collect():  # at most one row a bin
        df[r["bin"]] = r["n"]
    idf = np.where(df[:-1] > 0, np.log((1 + df[-1]) / (1 + df[:-1])) + 1e-3, 0.0)
    groups = [names[k : k + GROUP] for k in range(0, len(names), GROUP)]
    of = spark.createDataFrame([(x, g) for g, group in enumerate(groups) for x in group], "lang string, group int")
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "text", F.lit("langid"))).join(F.broadcast(of), "lang")  # a row a language
    per_language = min(per_language, max(10, SAMPLE // len(names)))
    sample = saved(spark, _sample(rows, "lang", per_language, "group"), "langid-sample")
    models = _models(sample.withColumn("label", F.col("lang")), idf, groups)
    if len(groups) == 1:
        discard(spark, sample)
        return models[0]
    of_all = sample.select("text", "lang", "draw", F.col("group").cast("string").alias("label"))
    of_all = _sample(of_all, "label", max(10, SAMPLE // len(groups)), "label").withColumn("group", F.lit(0))
    top = _models(of_all, idf, [sorted(str(g) for g in range(len(groups)))])[0]
    discard(spark, sample)
    top.parts = [models[int(g)] for g in top.languages]
    return top


def _probabilities(model: Model, codes: list[np.ndarray], off: np.ndarray) -> np.ndarray:
    w = np.vstack([model.weights, np.zeros((1, len(model.languages)))])  # the last bin is no n-gram
    total = np.zeros((len(off) - 1, w.shape[1]))
    for code in codes:
        for c in range(w.shape[1]):
            total[:, c] += np.add.reduceat(w[:, c].take(code), off[:-1])
    return _softmax((total / np.diff(off)[:, None] + model.bias) / model.temperature)


def _predict(model: Model):
    languages = [x for part in model.parts for x in part.languages] if model.parts else model.languages
    first = np.cumsum([0, *(len(part.languages) for part in model.parts or [])])
    names = pa.array(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "_lid_text"]
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for i, j, codes, off in _codes(batch.column("_lid_text")):
                p = _probabilities(model, codes, off)
                at, top = p.argmax(axis=1), p.max(axis=1)
                for g in np.unique(at) if model.parts else ():
                    inner, own = _probabilities(model.parts[g], codes, off), at == g
                    best[i:j][own], score[i:j][own] = first[g] + inner.argmax(axis=1)[own], (top * inner.max(axis=1))[own]
                if not model.parts:
                    best[i:j], score[i:j] = at, top
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), names.take(pa.array(best)), pa.array(score)], [*kept, "_lid_lang", "_lid_score"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with _lid_lang and _lid_score, from the text alone."""
    text = F.col("text").cast("string")
    if model is None:
        return docs.withColumns({"_lid_lang": F.lit(UNKNOWN), "_lid_score": F.lit(0.0)})
    fields = T.StructType([*docs.schema.fields, T.StructField("_lid_lang", T.StringType()), T.StructField("_lid_score", T.DoubleType())])
    out = docs.withColumn("_lid_text", text).mapInArrow(TK.tidied(_predict(model)), fields)
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return out.withColumns({"_lid_lang": F.when(letters, F.col("_lid_lang")).otherwise(UNKNOWN), "_lid_score": F.when(letters, F.col("_lid_score")).otherwise(0.0)})


def held_out() -> Column:
    """Documents that never train: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``docs`` with _lid_lang, _lid_score: learned on those of its rows that are not held out."""
    return predict(docs, train(spark, docs, ~held_out(), per_language))
