"""Resharding, mixing, the pipeline and the registered queries."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourmeter.llm import mixing, queries, sharding
from hourmeter.llm.frames import saved

SF = "/root/testdata/sf0.001"


def test_flow_moves_the_fewest_bytes():
    rnd = random.Random(6)
    for _ in range(30):
        supply = [rnd.randint(0, 4) for _ in range(3)]
        total = sum(supply)
        demand = [total // 3 + (k < total % 3) for k in range(3)]
        flow = sharding.min_cost_flow(supply, demand, lambda i, j: 0 if i == j else 1)
        assert [sum(x for (i, _), x in flow.items() if i == k) for k in range(3)] == supply
        assert all(sum(x for (_, j), x in flow.items() if j == k) <= demand[k] for k in range(3))
        units = [i for i, n in enumerate(supply) for _ in range(n)]
        places = [j for j, n in enumerate(demand) for _ in range(n)]
        best = min((sum(a != b for a, b in zip(units, p, strict=True)) for p in set(itertools.permutations(places))), default=0) if total <= 7 else None
        moved = sum(x for (i, j), x in flow.items() if i != j)
        assert best is None or moved == best
        assert moved == sum(max(0, s - d) for s, d in zip(supply, demand, strict=True))
    with pytest.raises(ValueError):
        sharding.min_cost_flow([3], [2], lambda i, j: 0)


def test_shards_are_even_gapless_and_keep_groups(spark, odd_documents):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice("abcdef") * rnd.randint(1, 9) for _ in range(rnd.randint(0, 40))), 1) for i in range(3000)]
    rows += [(5000 + i, "the same text " * 4, 1) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").unionByName(odd_documents.select("doc_id", "text", "n"))
    out = sharding.reshard(spark, docs, sharding.old_shard_by_hash(5), 8, blocks=512)
    assert out.columns[:3] == docs.columns
    got = out.collect()
    assert len(got) == len(rows) + odd_documents.count()
    load = [sum(r["_sh_size"] for r in got if r["_sh_new"] == k) for k in range(8)]
    assert max(load) - min(load) <= 0.02 * sum(load) / 8
    for k in range(8):
        assert sorted(r["_sh_slot"] for r in got if r["_sh_new"] == k) == list(range(sum(r["_sh_new"] == k for r in got)))
    homes = {}
    for r in got:
        assert homes.setdefault(r["text"], r["_sh_new"]) == r["_sh_new"]
        assert r["_sh_size"] == len((r["text"] or "").encode()) + 1
    assert sharding.reshard(spark, docs.limit(0), sharding.old_shard_by_hash(5), 8).count() == 0


def test_only_affected_shards_are_rewritten(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    out = sharding.reshard(spark, docs, sharding.old_shard_by_hash(4), 4, blocks=64)
    touched = sharding.rewrite(out, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    want = out.where(F.col("_sh_new").isin(touched)).select("doc_id", F.col("_sh_new").alias("shard"))
    assert sorted(map(tuple, back.select("doc_id", "shard").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize(("n_old", "n_new"), [(6, 3), (3, 6), (4, 4)])
def test_shards_are_rewritten_in_the_folder_of_the_old_layout(spark, tmp_path, n_old, n_new):
    path = str(tmp_path / "shards")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)] + [(None, None), (7, "")], "doc_id long, text string")
    docs.withColumn("shard", sharding.old_shard_by_hash(n_old)).repartition("shard").write.partitionBy("shard").parquet(path)
    out = sharding.reshard(spark, spark.read.parquet(path).drop("shard"), sharding.old_shard_by_hash(n_old), n_new, blocks=64)
    want = sorted(((r["doc_id"], r["text"], r["_sh_new"]) for r in out.collect()), key=str)
    assert sharding.rewrite(out, path, n_new)
    back = spark.read.schema("doc_id long, text string, shard int").parquet(path)
    assert sorted(((r["doc_id"], r["text"], r["shard"]) for r in back.collect()), key=str) == want


def test_untouched_shards_keep_their_files_and_emptied_ones_go(spark, tmp_path):
    path = tmp_path / "shards"
    rows = [(i, f"text {i}", i % 3) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, shard int").write.partitionBy("shard").parquet(str(path))
    kept = sorted(p.name for p in (path / "shard=0").iterdir())
    moved = spark.read.parquet(str(path)).select("doc_id", "text", F.col("shard").alias("_sh_old"), F.when(F.col("shard") == 1, 2).otherwise(F.col("shard")).alias("_sh_new"), F.col("doc_id").alias("_sh_slot"))
    assert sharding.rewrite(moved, str(path), 3) == [1, 2]
    assert sorted(p.name for p in (path / "shard=0").iterdir()) == kept and not (path / "shard=1").exists()
    back = spark.read.parquet(str(path)).select("doc_id", "shard").collect()
    assert sorted(map(tuple, back)) == [(i, 2 if k == 1 else k) for i, _, k in rows]


def test_registered_sharding_reads_rewritten_files(spark, tmp_path, odd_documents):
    odd_documents.write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op4_sharding(spark, str(tmp_path))
    assert any("llm-shards-" in f for f in out.inputFiles())
    got = sorted(((r["doc_id"], r["size"], r["text_crc32"], r["old_shard"]) for r in out.collect()), key=str)
    plain = sharding.with_size(odd_documents).select("doc_id", "_sh_size", F.crc32(F.coalesce("text", F.lit(""))), sharding.old_shard_by_hash(queries.OLD_SHARDS))
    assert got == sorted(map(tuple, plain.collect()), key=str)
    for name in range(queries.NEW_SHARDS):
        slots = sorted(r["slot"] for r in out.where(F.col("shard") == name).collect())
        assert slots == list(range(len(slots)))
    odd_documents.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert queries.op4_sharding(spark, str(tmp_path / "none")).count() == 0


def test_targets_are_shared_again_above_the_cap(spark):
    rows = [("a", 10, 1), ("b", 1000, 1), ("c", 500, 2), (None, 90, 1)]
    df = spark.createDataFrame([(i, s, z, n) for i, (s, z, n) in enumerate(rows)], "doc_id long, source string, size long, n long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    # a (weight 5) and null (weight 5, last) stop at three times their size; b and c share the rest 2 to 1
    assert got["a"] == 30 and got[None] == 270
    assert abs(got["b"] - (2100 - 300) * 2 / 3) < 1e-6 and abs(got["c"] - (2100 - 300) / 3) < 1e-6


def test_mix_comes_near_its_targets(spark, odd_documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "b", "c", "d", None])) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.copies(spark, docs).collect()
    assert len(out) == 2000 and all(r["n"] == 1 for r in out)
    for s in ("a", "b", "c", "d", None):
        own = [r for r in out if r["source"] == s]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(taken - own[0]["target"]) <= 60
        x = own[0]["target"] / own[0]["source_size"]
        assert {r["copies"] for r in own if r["size"]} <= {int(x), int(x) + 1} and all(r["copies"] <= 3 for r in own)
    again = {(r["doc_id"], r["copies"]) for r in mixing.copies(spark, docs.repartition(2)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in out}
    mixed = mixing.mix(spark, docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in out)


@pytest.mark.parametrize(("bucket_rows", "fan_in"), [(8192, 64), (100, 2)])
def test_mix_misses_a_target_by_small_documents_only(spark, monkeypatch, bucket_rows, fan_in):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    rnd = random.Random(21)
    rows = [(i, " ".join(["w"] * (2 + int(rnd.lognormvariate(3, 1.2)))), rnd.choice("aaaaaabbbc")) for i in range(4000)]
    rows += [(5000 + k, "w " * 6000, s) for k, s in enumerate("abc")]  # far larger than the others
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.copies(spark, docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert len(out) == 3
    for r in out:
        assert abs(r["taken"] - r["target"]) <= 100 and r["most"] <= 3


def test_mix_edge_cases(spark, odd_documents):
    out = mixing.copies(spark, odd_documents)
    assert out.agg(F.sum("n")).first()[0] == odd_documents.count()
    assert mixing.mix(spark, odd_documents).columns == odd_documents.columns
    assert mixing.copies(spark, odd_documents.limit(0)).count() == 0
    assert mixing.mix(spark, odd_documents.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pipeline_stages(spark):
    docs = queries.table(spark, SF, "documents")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = saved(spark, stage(spark, docs, SF), f"test-{name}")
        assert docs.count() > 0 and (k + 1 == len(corpus_pipeline.STAGES) or docs.columns == names)
    assert {"doc_id", "ids", "n_tokens"} <= set(docs.columns)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "passage_dedup", "source_mix", "tokens"]


def test_pipeline_takes_odd_and_empty_documents(spark, odd_documents):
    docs = odd_documents.withColumn("n_chars", F.length("text").cast("long"))
    for rows in (docs, docs.limit(0)):
        now = rows
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            now = saved(spark, stage(spark, now, SF), f"odd-{name}")
            assert k + 1 == len(corpus_pipeline.STAGES) or now.columns == docs.columns
