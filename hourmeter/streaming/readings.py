"""K1, row by row: a feed of readings whose repeats are decided in the stream.

The file stream (``ingest``) delivers whole files; a feed delivers readings in any order, again and late.  ``distinct_readings``
keeps state by natural key: the first reading of a key passes, and every repeat within ``horizon`` of it is dropped, in
whatever micro-batch it comes.  The watermark runs over the time of arrival, not over the readings' own times, so it only ends
the keys' state and no reading is dropped for being late, however late.  What comes again after its state has gone is caught by
the sink, which compares natural keys with the stored events (A11).  So a feed in any order and repetition ends in the
same events as one load of all its readings.

Of several copies of a key in one micro-batch, any one passes.  State lives in the query's checkpoint; a hot machine's keys
are spread, as its readings differ in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourmeter.plans.load import NATURAL_KEY, load_feed
from hourmeter.plans.store import Store

#: A reading: who, when, what, and its place in the feed.
READING = "ref_no string, event_time timestamp_ntz, event_type string, run_hours_seconds bigint, branch string, first_name string, surname string, seq bigint"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def distinct_readings(feed: DataFrame, horizon: str = "48 hours") -> DataFrame:
    """``feed`` (columns of READING) without the repeats of a natural key that arrive within ``horizon`` of its first reading."""
    columns = [c.strip().split()[0] for c in READING.split(",")]
    arrived = feed.select(*columns, F.current_timestamp().alias("_arrived")).withWatermark("_arrived", horizon)
    return arrived.dropDuplicatesWithinWatermark(NATURAL_KEY).select(*columns)


def stream_readings(
    spark: SparkSession, store: Store, feed: DataFrame, name: str, checkpoint: str, horizon: str = "48 hours", available_now: bool = True, processing_time: str | None = None
) -> StreamingQuery:
    """Load a streaming DataFrame of readings into the warehouse, one commit a micro-batch.  A micro-batch that is run again after
    a failure finds its number registered and does nothing."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")  # it looks every key up once more

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # a micro-batch comes in a session of the stream's own, in which Spark turns adaptive execution off for the stateful
        # plan's sake; the load of its rows is a batch job like any other, so it plans as the caller's session does
        streams = batch.sparkSession.conf
        held = streams.get("spark.sql.adaptive.enabled")
        streams.set("spark.sql.adaptive.enabled", adaptive)
        try:
            load_feed(spark, store, batch, f"{name}-{epoch_id:09d}")
        finally:
            streams.set("spark.sql.adaptive.enabled", held)

    writer = distinct_readings(feed, horizon).writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
