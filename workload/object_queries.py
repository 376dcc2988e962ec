"""Queries over object events, keys, results and the keyed store."""

from __future__ import annotations

from pyspark.sql import functions as F

import modspark as m
from modspark import fixed_values as V
from modspark import schemas
from modspark.scratch import scratch_folder
from workload import builders as B
from workload import tables as X
from workload.registry import query
from workload.tables import load, spread_files
from workload.text_queries import FIRST_PII, POLICY, SENTIMENT, docs

EXT = "['" + "', '".join(B.EXTENSIONS) + "']"
MANIFEST = f"""manifest AS (
  SELECT page_id, '{B.BUCKET}' AS bucket, 'in/' || page_id || '.' || {EXT}[page_id % 8 + 1] AS key,
         {EXT}[page_id % 8 + 1] AS ext, length(html)::bigint AS size, url FROM pages)"""


def sql_in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


ROUTES = f"""{MANIFEST}, routes AS (
  SELECT *, 'image' AS modality FROM manifest WHERE ext IN {sql_in(V.IMAGE_EXTENSIONS)}
  UNION ALL SELECT *, 'video' FROM manifest WHERE ext IN {sql_in(V.VIDEO_EXTENSIONS)}
  UNION ALL SELECT *, 'audio' FROM manifest WHERE ext IN {sql_in(V.AUDIO_EXTENSIONS)}
  UNION ALL SELECT *, 'text' FROM manifest WHERE ext IN {sql_in(V.TEXT_EXTENSIONS)})"""


def events(spark, sf):
    """Object events, parsed back from their JSON documents."""
    docs_ = B.object_event_json(spark, sf)
    parsed = docs_.select(F.from_json("value", schemas.OBJECT_EVENTS).alias("v")).select("v.*")
    return m.parse_object_events(parsed)


def manifest(spark, sf):
    return m.with_extension(m.with_uri(B.media_manifest(spark, sf)))


@query(
    "object_events",
    f"""WITH {MANIFEST} SELECT bucket, key, size, md5(key) AS etag, lpad(page_id::varchar, 6, '0') AS sequencer,
        epoch_us(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 MINUTE) // 1000000 AS event_second FROM manifest""",
)
def object_events(spark, sf):
    """Event documents written as files, read back by the reader."""
    folder = scratch_folder(spark, "events")
    B.object_event_json(spark, sf).write.text(folder)
    return m.read_object_events(spark, folder).withColumn("event_second", F.unix_seconds("event_time")).drop("event_time")


@query(
    "media_manifest",
    f"WITH {MANIFEST} SELECT 's3://' || bucket || '/' || key AS file_uri, size FROM manifest",
)
def media_manifest(spark, sf):
    return manifest(spark, sf).select("file_uri", "size")


@query(
    "media_objects",
    "SELECT page_id, strlen(html)::bigint + 1 AS size FROM pages",
)
def media_objects(spark, sf):
    """Pages written as one file each, listed without reading them."""
    folder = scratch_folder(spark, "media")
    # A file costs the same however small it is, so the files are dealt by number and not by bytes.
    folders = m.write_text_objects(spread_files(load(spark, sf, "pages"), "page_id"), folder, "page_id", "html")
    page = F.regexp_extract("file_uri", "page_id=(-?[0-9]+)", 1).cast("bigint")
    return m.read_by_folders(
        spark, folders, lambda paths: m.list_media_objects(spark, paths).select(page.alias("page_id"), "size")
    )


@query("object_uri", f"WITH {MANIFEST} SELECT page_id, 's3://' || bucket || '/' || key AS file_uri FROM manifest")
def object_uri(spark, sf):
    return m.with_uri(B.media_manifest(spark, sf)).select("page_id", "file_uri")


@query("extension", "SELECT page_id, string_split(url, '.')[-1] AS ext FROM pages")
def extension(spark, sf):
    return m.with_extension(load(spark, sf, "pages"), "url").select("page_id", "ext")


@query("route_modalities", f"WITH {ROUTES} SELECT page_id, ext, modality FROM routes")
def route_modalities(spark, sf):
    return m.route_modalities(manifest(spark, sf)).select("page_id", "ext", "modality")


@query(
    "unsupported_objects",
    f"WITH {ROUTES} SELECT page_id, ext FROM manifest WHERE page_id NOT IN (SELECT page_id FROM routes)",
)
def unsupported_objects(spark, sf):
    return m.unsupported_objects(manifest(spark, sf)).select("page_id", "ext")


@query(
    "result_key",
    f"""WITH {MANIFEST} SELECT page_id, string_split(key, '/')[1] || '/{V.RESULTS_FOLDER}/'
        || string_split(key, '/')[-1] || '.json' AS result_key FROM manifest""",
)
def result_key(spark, sf):
    return m.with_result_key(B.media_manifest(spark, sf)).select("page_id", "result_key")


@query(
    "transcript_key",
    f"""WITH {MANIFEST} SELECT page_id,
        string_split(key, '.')[1] || sha256(key)[1:7] || '.json' AS transcript_key FROM manifest""",
)
def transcript_key(spark, sf):
    return m.with_transcript_key(B.media_manifest(spark, sf)).select("page_id", "transcript_key")


@query(
    "result_documents",
    f"""WITH {POLICY} SELECT 'doc/' || doc_id || '.txt' AS file_uri, 'text' AS modality, flag,
        'doc/{V.RESULTS_FOLDER}/' || doc_id || '.txt.json' AS result_key
        FROM documents JOIN verdict USING (doc_id) WHERE length(text) > 0""",
)
def result_documents(spark, sf):
    """Results written as JSON documents per modality and read back."""
    texts = docs(spark, sf).select(F.concat(F.lit("doc/"), "doc_id", F.lit(".txt")).alias("file_uri"), "text", "lang")
    scored = m.moderate_text(texts, lang="lang", policy=X.PHRASES, id_col="file_uri")
    nested = scored.select(
        "file_uri",
        F.when(F.length("text") > 0, m.text_result(None)).alias("Text_moderation"),
        F.lit(None).cast("string").alias("Image_moderation"),
    )
    path = scratch_folder(spark, "results")
    m.write_results(m.with_result_key(nested, "file_uri"), path)
    back = spark.read.schema(
        "file_uri STRING, result_key STRING, modality STRING, Text_moderation STRUCT<verdict:STRUCT<flag:BOOLEAN>>"
    ).json(path)
    return back.select("file_uri", "modality", F.col("Text_moderation.verdict.flag").alias("flag"), "result_key")


LATEST = """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
    arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1"""


@query("latest_per_key", LATEST)
def latest_per_key(spark, sf):
    e = load(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    newest = m.latest_per_key(e, "user_id", ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


@query("upsert_latest", LATEST)
def upsert_latest(spark, sf):
    """Two puts into a store: all events by value halves, the second replayed, then merged."""
    e = load(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    store = scratch_folder(spark, "store")
    m.upsert_latest(e.filter("value >= 20"), store, "user_id", ["ts", "event_id"])
    second = m.upsert_latest(e.filter("value < 20"), store, "user_id", ["ts", "event_id"])
    m.upsert_latest(e.filter("value < 20"), store, "user_id", ["ts", "event_id"], writer=second)
    return m.read_latest(spark, store, "user_id", ["ts", "event_id"]).drop("ts")


@query("compacted_store", LATEST)
def compacted_store(spark, sf):
    """Puts, a compaction by buckets, puts for some of the keys, another compaction, and one more put."""
    e = load(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    store, order = scratch_folder(spark, "store"), ["ts", "event_id"]
    m.upsert_latest(e.filter("value >= 30"), store, "user_id", order)
    m.compact_buckets(spark, store, "user_id", order, buckets=16)
    m.upsert_latest(e.filter("value < 30 AND value >= 10"), store, "user_id", order)
    m.compact_buckets(spark, store, "user_id", order)
    m.upsert_latest(e.filter("value < 10"), store, "user_id", order)
    return m.read_latest(spark, store, "user_id", order).drop("ts")


# --- whole objects ------------------------------------------------------------------------------


@query(
    "moderate_objects",
    f"""WITH {ROUTES}, {POLICY}, {SENTIMENT}, {FIRST_PII},
    lab AS (SELECT event_id // 10 AS n, count(*) AS k FROM events GROUP BY 1)
    SELECT 's3://' || m.bucket || '/' || m.key AS file_uri,
      coalesce(CASE WHEN ext IN {sql_in(V.IMAGE_EXTENSIONS)} THEN lab.k END, -1)::int AS n_labels,
      coalesce(CASE WHEN ext IN {sql_in(V.AUDIO_EXTENSIONS)} THEN c.n END, -1)::int AS n_segments,
      CASE WHEN ext IN {sql_in(V.TEXT_EXTENSIONS)} THEN sent.sentiment END AS sentiment,
      CASE WHEN ext IN {sql_in(V.TEXT_EXTENSIONS)} THEN verdict.flag END::varchar AS flag,
      coalesce(CASE WHEN ext IN {sql_in(V.TEXT_EXTENSIONS)} AND sent.doc_id IS NOT NULL THEN coalesce(first.n, 0) END, -1)::int AS n_pii
    FROM manifest m LEFT JOIN lab ON lab.n = page_id
    LEFT JOIN (SELECT conv_id, count(*)::int AS n FROM conversations GROUP BY 1) c ON conv_id = page_id
    LEFT JOIN sent ON sent.doc_id = page_id LEFT JOIN verdict ON verdict.doc_id = page_id
    LEFT JOIN first ON first.doc_id = page_id
    WHERE page_id IN (SELECT page_id FROM routes)""",
)
def moderate_objects(spark, sf):
    """Object n is image n, conversation n or document n, by its extension."""
    located = m.with_uri(B.media_manifest(spark, sf)).select("page_id", "file_uri")
    labels = m.parse_detections(B.moderation_json(spark, sf), "payload", "moderation")
    images = labels.withColumn("page_id", F.regexp_extract("file_uri", "[0-9]+$", 0).cast("bigint"))
    image_side = located.join(images.drop("file_uri"), "page_id").select("file_uri", "ModerationLabels")
    talks = m.parse_transcripts(B.transcript_json(spark, sf), "payload")
    # A long conversation is several recordings; all of them belong to its object, in order.
    name = F.split("job_name", "-")
    parts = talks.select(
        F.get(name, F.lit(1)).try_cast("bigint").alias("page_id"),
        F.struct(F.get(name, F.lit(2)).try_cast("bigint").alias("part"), "segments").alias("p"),
    )

    def by_part(x, y):
        return F.when(x["part"] < y["part"], -1).when(x["part"] > y["part"], 1).otherwise(0)

    whole = parts.groupBy("page_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list("p"), by_part), lambda x: x["segments"])).alias("segments")
    )
    audio_side = located.join(whole, "page_id").select("file_uri", "segments")
    texts = located.join(docs(spark, sf).withColumnRenamed("doc_id", "page_id"), "page_id").drop("page_id")
    result = m.moderate_objects(
        events(spark, sf), images=image_side, recordings=audio_side, texts=texts,
        lang="lang", policy=X.PHRASES, lexicon=X.SENTIMENTS,
    )
    text = F.col("Text_moderation")
    return result.select(
        "file_uri",
        F.coalesce(F.size("Image_moderation.ModerationLabels"), F.lit(-1)).alias("n_labels"),
        F.coalesce(F.size("Audio_moderation.segments"), F.lit(-1)).alias("n_segments"),
        text["analysis"]["sentiment"].alias("sentiment"),
        text["verdict"]["flag"].cast("string").alias("flag"),
        F.coalesce(F.size(text["analysis"]["pii"]), F.lit(-1)).alias("n_pii"),
    )
