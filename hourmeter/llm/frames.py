"""Small DataFrame helpers for the llm operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from hourmeter.session import checkpoint_root


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: the lineage ends
    here, and any executor can read it again after a loss.  The names of the stages before it are then
    released, so that Spark can drop their shuffle files."""
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out._saved_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by ``saved`` that nothing reads any more."""
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table._saved_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
