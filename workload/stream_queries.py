"""The streaming plans run to the end of their input, then read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import modspark as m
from modspark import fixed_values as V
from modspark.scratch import scratch_folder
from workload import builders as B
from workload import tables as X
from workload.object_queries import ROUTES, sql_in
from workload.registry import query
from workload.tables import load
from workload.text_queries import POLICY, SENTIMENT, docs
from workload.video_queries import JOBS


@query(
    "stream_moderation",
    f"""WITH {ROUTES} SELECT 's3://' || bucket || '/' || key AS file_uri, lpad(page_id::varchar, 6, '0') AS sequencer,
        string_agg(modality, '+' ORDER BY modality) AS modalities FROM routes GROUP BY ALL""",
)
def stream_moderation(spark, sf):
    """Every event document is delivered twice; the store holds each supported object once."""
    folder = scratch_folder(spark, "stream")
    documents = B.object_event_json(spark, sf)
    documents.write.mode("append").text(f"{folder}/in")
    documents.write.mode("append").text(f"{folder}/in")
    m.stream_moderation(
        spark, f"{folder}/in", f"{folder}/store", f"{folder}/checkpoint"
    ).awaitTermination()
    stored = m.read_latest(spark, f"{folder}/store", "file_uri", ["sequencer"])
    return stored.select("file_uri", "sequencer", F.array_join(F.array_sort("modalities"), "+").alias("modalities"))


@query(
    "stream_moderation_of_texts",
    f"""WITH {ROUTES}, {POLICY}, {SENTIMENT}
    SELECT DISTINCT 's3://' || bucket || '/' || key AS file_uri,
      CASE WHEN ext IN {sql_in(V.TEXT_EXTENSIONS)} THEN sentiment END AS sentiment,
      CASE WHEN ext IN {sql_in(V.TEXT_EXTENSIONS)} THEN flag END::varchar AS flag
    FROM routes LEFT JOIN sent ON sent.doc_id = page_id LEFT JOIN verdict ON verdict.doc_id = page_id""",
)
def stream_moderation_of_texts(spark, sf):
    """Each batch of the stream is moderated with the texts of its objects."""
    folder = scratch_folder(spark, "stream")
    B.object_event_json(spark, sf).write.text(f"{folder}/in")
    located = m.with_uri(B.media_manifest(spark, sf)).select("page_id", "file_uri")
    texts = located.join(docs(spark, sf).withColumnRenamed("doc_id", "page_id"), "page_id").drop("page_id")
    m.stream_moderation(
        spark, f"{folder}/in", f"{folder}/store", f"{folder}/checkpoint", sides=lambda batch: {"texts": texts},
        lang="lang", policy=X.PHRASES, lexicon=X.SENTIMENTS,
    ).awaitTermination()
    text = F.col("Text_moderation")
    return m.read_latest(spark, f"{folder}/store", "file_uri", ["sequencer"]).select(
        "file_uri", text["analysis"]["sentiment"].alias("sentiment"), text["verdict"]["flag"].cast("string").alias("flag")
    )


@query(
    "stream_match_jobs",
    f"""WITH {JOBS} SELECT n.event_id, n.job_id, n.status, j.submitted_as FROM notices n
    JOIN jobs j USING (job_id) JOIN events e ON e.event_id = n.event_id JOIN events s ON s.event_id = j.submitted_as
    WHERE e.ts BETWEEN s.ts AND s.ts + INTERVAL 6 HOUR""",
)
def stream_match_jobs(spark, sf):
    """Jobs and notices as two streams; a notice counts within six hours of its job."""
    return matched_stream(spark, sf, "60 days", "inner").select("event_id", "job_id", "status", "submitted_as")


# A notice is given up once both streams have passed it; the last day is left to the streams' ends.
DEAD_LETTERS = f"""WITH {JOBS}, ends AS (
      SELECT least(max(s.ts), (SELECT max(ts) FROM events)) - INTERVAL 1 DAY AS until FROM jobs JOIN events s ON s.event_id = submitted_as)
    SELECT n.event_id, n.job_id, n.status FROM notices n JOIN events e USING (event_id), ends
    WHERE e.ts < until AND NOT EXISTS (
      SELECT 1 FROM jobs j JOIN events s ON s.event_id = j.submitted_as
      WHERE j.job_id = n.job_id AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 6 HOUR)"""


@query("stream_unmatched_notices", DEAD_LETTERS)
def stream_unmatched_notices(spark, sf):
    """Dead letters of the two streams: notices whose job did not come in time."""
    out = matched_stream(spark, sf, "1 hour", "right_outer")
    times = load(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    submitted = B.submitted_jobs(spark, sf).join(times, F.col("submitted_as") == F.col("event_id"))
    last = submitted.agg(F.max("at").alias("a")).crossJoin(times.agg(F.max("at").alias("b")))  # one row
    until = F.least("a", "b") - F.expr("INTERVAL 1 DAY")
    dead = out.filter("submitted_as IS NULL").join(F.broadcast(last), F.col("sent_at") < until)
    return dead.select("event_id", "job_id", "status")


def matched_stream(spark, sf, watermark, how):
    """Both streams run to their ends; what they emitted."""
    folder = scratch_folder(spark, "jobs")
    times = load(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    jobs = B.submitted_jobs(spark, sf).join(
        times.withColumnRenamed("event_id", "submitted_as"), "submitted_as"
    )
    jobs.withColumnRenamed("at", "submitted_at").write.parquet(f"{folder}/jobs")
    # Microseconds are written out: by default JSON keeps milliseconds.
    sent_json = B.job_notice_json(spark, sf).join(times, "event_id").withColumnRenamed("at", "sent_at")
    sent_json.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{folder}/notices")
    job_schema = spark.read.parquet(f"{folder}/jobs").schema
    submitted = spark.readStream.schema(job_schema).parquet(f"{folder}/jobs")
    sent = m.read_job_notices(spark, f"{folder}/notices", True, "event_id BIGINT, sent_at TIMESTAMP")
    matched = m.stream_match_jobs(
        submitted, sent, watermark=watermark, max_wait="6 hours", how=how, spread_by=["event_id"]
    )
    (
        matched.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/matched")
        .awaitTermination()
    )
    return spark.read.schema(matched.schema).parquet(f"{folder}/matched")
