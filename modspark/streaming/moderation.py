"""Object events as a stream: dedup, moderate, put."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from modspark.plans.objects import moderate_objects
from modspark.sources.objects import read_object_events
from modspark.sources.results import upsert_latest

# Every batch runs with its query's id, which lives in the checkpoint.
QUERY_ID = "sql.streaming.queryId"


def stream_moderation(
    spark: SparkSession,
    in_dir: str,
    out: str,
    ckpt: str,
    *,
    sides: Callable[[DataFrame], dict] | None = None,
    watermark: str | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    **options,
) -> StreamingQuery:
    """New object events → moderated objects → keyed store ``out``.

    By default no event is dropped: a redelivered one merely puts the same record again.  With a
    ``watermark``, redelivered events (same bucket, key, sequencer) within it are dropped and the
    state holds only these keys; events that arrive later than it are dropped too (counted in the
    query's progress), so choose it beyond the longest delay.  ``sides(batch)`` returns the detector
    frames for ``moderate_objects``.  A batch is written under the query's id and its batch id: a
    replay after a failure replaces it, and a query with a new checkpoint replaces nothing.
    """
    fresh = read_object_events(spark, in_dir, streaming=True)
    if watermark is not None:
        fresh = fresh.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(
            ["bucket", "key", "sequencer"]
        )

    def put(batch: DataFrame, batch_id: int) -> None:
        frames = sides(batch) if sides else {}
        upsert_latest(
            moderate_objects(batch, **frames, **options), out, "file_uri", ["sequencer"],
            writer=batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID), batch_id=batch_id,
        )

    writer = fresh.writeStream.foreachBatch(put).option("checkpointLocation", ckpt)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
