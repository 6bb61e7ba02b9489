"""Substring dedup, SimHash and embedding near-duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hourmeter.llm import simhash, substring, vector_join
from hourmeter.llm.graph import components

from .conftest import WORDS


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_substring(rows, window=13):
    first = {}
    for d, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1 if d is not None else 0):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_leaves", [200_000, 2], ids=["subtrees", "deep prefixes"])
def test_substring_matches_brute_force(spark, odd_documents, max_leaves):
    rnd = random.Random(5)
    passage = [rnd.choice(WORDS) for _ in range(60)]
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    for d in range(100, 160):  # few words, so passages of many lengths repeat; a third of the documents share one
        w = [rnd.choice(WORDS[:3] if d % 7 == 0 else WORDS) for _ in range(rnd.randint(0, 90))]
        if d % 3 == 0:
            at = rnd.randint(0, len(w))
            w[at:at] = passage[rnd.randint(0, 20) : rnd.randint(30, 60)]
        rows.append((d, rnd.choice([" ", "\n", " \t "]).join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = substring.remove_repeats(spark, docs, max_leaves=max_leaves).collect()
    assert sorted(((r["doc_id"], r["_sub_n_words"], r["_sub_n_removed"], r["_sub_kept_text"]) for r in out), key=str) == brute_substring(rows)
    assert all(r["_sub_n_removed"] == sum(s["words"] for s in r["_sub_spans"]) for r in out)


def test_substring_keeps_columns_and_takes_empty_tables(spark, odd_documents):
    out = substring.remove_repeats(spark, odd_documents)
    assert out.columns[: len(odd_documents.columns)] == odd_documents.columns
    assert out.count() == odd_documents.count()
    assert substring.remove_repeats(spark, odd_documents.limit(0)).count() == 0


def brute_fingerprint(text, k=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def smallest_reachable(near, ids):
    label = np.arange(len(ids))
    while True:
        new = np.where(near | np.eye(len(ids), dtype=bool), label[None, :], len(ids)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_simhash_fingerprints(spark, odd_documents):
    rows = odd_documents.collect()
    got = simhash.text_fingerprints(pa.array([r["text"] for r in rows]))
    assert [int(x) for x in got] == [brute_fingerprint(r["text"]) for r in rows]
    out = simhash.simhash_groups(spark, odd_documents).collect()
    assert len(out) == len(rows)
    zero = [r for r in out if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {3} and len(zero) == 4  # null, empty and blank texts are one group
    assert simhash.simhash_groups(spark, odd_documents.limit(0)).count() == 0


@pytest.mark.parametrize("probe_from", [1024, 3], ids=["neighbours", "probes"])
def test_simhash_links_match_all_pairs(spark, monkeypatch, probe_from):
    monkeypatch.setattr(simhash, "PROBE_FROM", probe_from)
    rnd = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            fps.add(base)
            for b in rnd.sample(range(64), rnd.randint(0, 3)):
                base ^= 1 << b
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3)
    roots = {r["node"]: r["root"] for r in components(spark, simhash.fingerprint_links(df, 2), "test").collect()}
    u = np.array(fps, np.int64).view(np.uint64)
    label = smallest_reachable(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2, fps)
    assert {x: roots.get(x, x) for x in fps} == {x: fps[k] for x, k in zip(fps, label, strict=True)}


def test_pivot_tables_are_of_small_cells_and_slices(monkeypatch):
    rnd = np.random.default_rng(6)
    fp = np.concatenate([np.arange(3000, dtype=np.uint64), rnd.integers(0, 1 << 12, 900).astype(np.uint64) + np.uint64(1 << 40), np.array([5, 6], np.uint64)])
    cell = np.repeat(np.arange(5), [3000, 300, 300, 300, 2])
    seen, table = [], simhash.pivot_table
    monkeypatch.setattr(simhash, "TABLE_ROWS", 400, raising=False)
    monkeypatch.setattr(simhash, "pivot_table", lambda x, n: seen.append(len(x)) or table(x, n))
    a, b = simhash._near(fp, cell, 2)
    assert sum(seen) == 902 and max(seen) <= 400
    apart = np.bitwise_count(fp[:, None] ^ fp[None, :])
    i, j = np.nonzero((apart <= 2) & (cell[:, None] == cell[None, :]) & (fp[:, None] != fp[None, :]))
    want = {(int(x), int(y)) for x, y in zip(i, j, strict=True) if x < y}
    assert {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True) if fp[x] != fp[y]} == want


def test_one_document_of_each_group_stays(spark, odd_documents):
    rows = odd_documents.collect()
    kept = simhash.keep_one(spark, odd_documents)
    assert kept.columns == odd_documents.columns
    # one row of each group of fingerprints; two groups can have the same smallest id
    named = [r for r in rows if r["doc_id"] is not None]
    u = np.array([brute_fingerprint(r["text"]) for r in named], np.uint64)
    label = smallest_reachable(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2, named)
    least = {}
    for r, k in zip(named, label, strict=True):
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    of = {int(x): k for x, k in zip(u, label, strict=True)}
    stays = [r for r in kept.collect() if r["doc_id"] is not None]
    assert sorted((of[brute_fingerprint(r["text"])], r["doc_id"]) for r in stays) == sorted(least.items())
    groups = {(r["component_id"], of[int(r["fingerprint"], 16)]) for r in simhash.simhash_groups(spark, odd_documents).collect() if r["doc_id"] is not None}
    assert sorted(d for _, d in least.items()) == sorted(c for c, _ in groups)
    assert sum(r["doc_id"] is None for r in rows) == kept.where("doc_id is null").count()
    assert simhash.keep_one(spark, odd_documents.limit(0)).count() == 0


def test_each_group_of_fingerprints_keeps_exactly_one_row(spark):
    one, two = " ".join(WORDS), " ".join(reversed(WORDS))
    rows = [(1, one, "a"), (2, two, "a"), (2, one, "a"), (2, two, "b"), (2, two, "b"), (5, None, "a"), (5, "", "a"), (6, "", None), (7, "elm oak", "x"), (7, "elm  oak", "y")]
    rows += [(3, "own words of three", None), (3, "own words of three", None), (8, "the last one", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    fps = [brute_fingerprint(r[1]) for r in rows]
    label = smallest_reachable(np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None, :]) <= 2, rows)
    group = {r: int(k) for r, k in zip(rows, label, strict=True)}
    kept = [tuple(r) for r in simhash.keep_one(spark, docs.repartition(4)).collect()]
    assert sorted(group[r] for r in kept) == sorted(set(group.values()))
    assert all(r[0] == min(x[0] for x in rows if group[x] == group[r]) for r in kept)
    again = [tuple(r) for r in simhash.keep_one(spark, docs.orderBy(F.desc("doc_id"), F.desc("source")).coalesce(1)).collect()]
    assert sorted(again, key=str) == sorted(kept, key=str)


def test_embedding_links_match_brute_force(spark):
    rnd = np.random.default_rng(11)
    rows, centres = [], rnd.normal(size=(25, 16))
    for i in range(300):
        v = centres[i % 25] + rnd.normal(size=16) * rnd.choice([0.01, 0.03, 0.05])
        rows.append((i * 3, [float(np.float32(x)) for x in v * rnd.uniform(0.1, 9)], int(i % 4)))
    rows += [(2000 + i, rows[0][1], rows[0][2]) for i in range(40)]  # copies
    strange = [None, [], [0.0] * 16, [-0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0]]
    rows += [(3000 + i, v, 0) for i, v in enumerate(strange)] + [(4000, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r["vec_id"]: r for r in vector_join.near_duplicates(spark, df, 0.98).collect()}
    assert len(got) == len(rows)
    good = [r for r in rows if r[2] is not None and r[1] and None not in r[1] and len(r[1]) == 16 and np.isfinite(r[1]).all() and any(r[1])]
    good.sort()
    x = np.array([r[1] for r in good])
    norm = np.sqrt((x * x).sum(axis=1))
    label = np.array([r[2] for r in good])
    near = (x @ x.T / np.outer(norm, norm) >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = smallest_reachable(near, good)
    for k, r in enumerate(good):
        assert (got[r[0]]["n_links"], got[r[0]]["component_id"]) == (near[k].sum(), good[root[k]][0])
    for i in [*range(3000, 3008), 4000]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert vector_join.near_duplicates(spark, df.limit(0)).count() == 0


def test_a_vec_id_on_several_vectors_and_labels(spark):
    rnd = np.random.default_rng(12)
    centres = rnd.normal(size=(6, 8))
    rows = [(int(i % 9) - 1, [float(x) for x in centres[i % 6] + rnd.normal(size=8) * 0.03], int(i // 6 % 2)) for i in range(60)]
    rows += [(7, rows[0][1], rows[0][2]), (7, rows[0][1], rows[0][2]), (-1, rows[1][1], rows[1][2])]
    rows += [(100, [1.0] + [0.0] * 7, 5), (100, [1.0, 0.01] + [0.0] * 6, 5), (100, [0.0, 1.0] + [0.0] * 6, 5), (100, [1.0] + [0.0] * 7, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in vector_join.near_duplicates(spark, df, 0.98).collect())
    x, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    norm = np.sqrt((x * x).sum(axis=1))
    near = (x @ x.T / np.outer(norm, norm) >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = smallest_reachable(near, rows)
    first = {k: min(r[0] for r, j in zip(rows, root, strict=True) if j == k) for k in set(root)}
    assert got == sorted((r[0], int(near[k].sum()), first[root[k]]) for k, r in enumerate(rows))


def test_blocks_of_a_hot_cell_add_up(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "BLOCK_BYTES", 64 * 4 * 8)
    rnd = np.random.default_rng(2)
    v = [[1.0, 0.0, 0.0, float(x)] for x in rnd.uniform(-0.01, 0.01, 300)]  # all linked with all
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = vector_join.near_duplicates(spark, df).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(299, 0)}


def test_any_number_of_pivots_gives_the_same_links(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, 3))  # few dimensions: many links, many boundaries
    df = spark.createDataFrame([(i, [float(v) for v in row], i % 2) for i, row in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = []
    for k in (1, 16, 64):
        monkeypatch.setattr(vector_join, "pivots_that_pay", lambda pivots, *a, k=k: min(k, len(pivots)))
        found.append(sorted(map(tuple, vector_join.near_duplicates(spark, df).collect())))
    assert found[0] == found[1] == found[2] and sum(r[1] for r in found[0]) > 50


def test_clustered_vectors_take_more_pivots_than_scattered_ones():
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(64, 64))
    clustered = np.repeat(centres, 20, axis=0) + rnd.normal(size=(1280, 64)) * 0.01
    scattered = rnd.normal(size=(1280, 64))
    k = [vector_join.pivots_that_pay(x[rnd.permutation(1280)][:64], x, 0.2, 1e6) for x in map(vector_join._unit, (clustered, scattered))]
    assert k[0] == 64 >= k[1]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark, spark.createDataFrame(chain, "src long, dst long"), "test").collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{k: 100 for k in range(101, 140)}}


def test_kept_digest_is_of_the_kept_words(spark):
    df = spark.createDataFrame([(1, " a  b\nc ")], "doc_id long, text string")
    r = substring.remove_repeats(spark, df).first()
    assert hashlib.sha256(r["_sub_kept_text"].encode()).hexdigest() == hashlib.sha256(b"a b c").hexdigest()
