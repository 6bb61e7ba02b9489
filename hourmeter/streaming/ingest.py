"""K1: the daily drop folder as a file stream.

Structured Streaming's file source remembers which paths it has seen (in the
query's checkpoint), so each micro-batch carries only new files.  Each batch's
file names (the stream lists files and reads none) are handed to the
batch load together with the folder's files without a byte, which no reader
returns; ``run_ingest`` takes lengths and times from the folder's listing and still
applies the (name, checksum) pick, the natural-key dedup and the registry
commit, so a replayed micro-batch after a failure inserts nothing twice.
``trigger(availableNow=True)`` processes what is there and stops: the
scheduled daily run.  A changed file re-delivered under the same path is not a
new path for the stream; the scheduled batch run (``run_ingest`` on the folder)
picks it up through its checksum.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourmeter.functions import exprs as X
from hourmeter.plans.load import run_ingest
from hourmeter.plans.store import Store
from hourmeter.sources import files as FS


#: what a file listing gives; the content column is never asked for
LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def stream_ingest(
    spark: SparkSession,
    store: Store,
    incoming: str,
    machine_list_path: str,
    checkpoint: str,
    triggered_by: str = "schedule",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    reader = spark.readStream.format("binaryFile").schema(LISTED).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(FS.glob_escaped(incoming)).select("path")  # without the content column no file is read

    def load_batch(batch, epoch_id: int) -> None:
        named = batch.select(X.file_basename("path").alias("file_name"))
        # files without a byte, unless they failed since they were written
        failed = store.read("ingestion_runs").where("status = 'failed'").select("file_name", F.unix_millis("finished_at").alias("_at"))
        empty = FS.list_daily_files(spark, incoming).where("length = 0")
        empty = empty.join(failed, "file_name", "left").groupBy("file_name", "modified").agg(F.max("_at").alias("_at"))
        empty = empty.where(F.col("_at").isNull() | (F.col("_at") < F.col("modified"))).select("file_name")
        run_ingest(spark, store, incoming, machine_list_path, triggered_by=triggered_by, only=named.union(empty).checkpoint())

    w = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
