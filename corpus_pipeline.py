"""Corpus pipeline: documents through language ID, near-dedup, passage dedup, mixing and tokenising.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one as Parquet in the
shared checkpoint folder and gives the next stage what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.llm import bpe, langid, mixing, queries, simhash, substring
from hourmeter.llm.frames import saved

#: The language model is as good as undecided below this probability.
MIN_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language that the model can tell, go."""
    out = langid.identify(spark, docs)
    return out.where((F.col("_lid_lang") != langid.UNKNOWN) & (F.col("_lid_score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 2 bits) stays."""
    return simhash.keep_one(spark, docs, shingle=3, max_bits=2)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word passages that also stand in a smaller document go.  A text that loses words becomes
    its kept words joined by one space; any other text stays as it is.  No document goes."""
    out = substring.remove_repeats(spark, docs)
    text = F.when(F.col("_sub_n_removed") > 0, F.col("_sub_kept_text")).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_sub_n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 in turn: a document stands there as often as the mix takes it."""
    return mixing.mix(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of its text, their number, and digests of the ids and of the bytes decoded from them."""
    encoded = bpe.encode(docs, *queries.bpe_files())
    return queries.bpe_digest(encoded, "ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: The stages learn, follow links and draw lots, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
