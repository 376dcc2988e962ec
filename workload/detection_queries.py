"""Queries over detector documents: images, transcripts, faces."""

from __future__ import annotations

from pyspark.sql import functions as F

import modspark as m
from modspark import fixed_values as V
from modspark.operators.routing import with_extension, with_modalities
from modspark.scratch import scratch_folder
from workload import builders as B
from workload import tables as X
from workload.object_queries import ROUTES, sql_in
from workload.object_queries import events as object_events
from workload.registry import TOKENS, query, values
from workload.tables import load, spread_files
from workload.text_queries import docs, pii_sql

CONF = "least(value / 5, 100.0)"
PARENT = "CASE WHEN event_type = 'error' THEN '' ELSE 'activity' END"


def labels(spark, sf):
    return m.parse_detections(B.moderation_json(spark, sf), "payload", "moderation")


@query(
    "moderation_labels",
    f"""SELECT 'img/' || (event_id // 10) AS file_uri, event_type AS name, {PARENT} AS parent,
        {CONF} AS confidence, event_type = 'error' AS is_top_level FROM events""",
)
def moderation_labels(spark, sf):
    return m.moderation_labels(labels(spark, sf))


@query(
    "min_confidence",
    f"SELECT event_id, {CONF} AS confidence FROM events WHERE {CONF} >= 60",
)
def min_confidence(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id", F.least(F.col("value") / 5, F.lit(100.0)).alias("confidence")
    )
    return m.min_confidence(e)


@query(
    "review_decision",
    f"""SELECT 'img/' || (event_id // 10) AS file_uri,
        CASE WHEN max({CONF}) >= 60 THEN 'Human review' ELSE 'Pass' END AS decision FROM events GROUP BY 1""",
)
def review_decision(spark, sf):
    return m.review_decision(labels(spark, sf), "ModerationLabels").select("file_uri", "decision")


@query("exact_scores", "SELECT event_id, value::varchar::decimal(38, 24)::varchar AS value FROM events")
def exact_scores(spark, sf):
    e = m.exact_scores(load(spark, sf, "events").select("event_id", "value"), ["value"])
    return e.withColumn("value", F.col("value").cast("string"))


@query(
    "parse_detections",
    """SELECT 'moderation' AS kind, 'img/' || (event_id // 10) AS file_uri, count(*)::int AS n FROM events GROUP BY ALL
       UNION ALL SELECT 'faces', 'img/' || (vec_id // 10), count(*)::int FROM embeddings GROUP BY ALL
       UNION ALL SELECT 'celebrities', 'img/' || c_custkey, 1 FROM customer""",
)
def parse_detections(spark, sf):
    def counted(df, kind, *arrays):
        parsed = m.parse_detections(df, "payload", kind)
        n = sum((F.size(a) for a in arrays), F.lit(0))
        return parsed.select(F.lit(kind).alias("kind"), "file_uri", n.alias("n"))

    return (
        counted(B.moderation_json(spark, sf), "moderation", "ModerationLabels")
        .unionByName(counted(B.faces_json(spark, sf), "faces", "FaceDetails"))
        .unionByName(counted(B.celebrities_json(spark, sf), "celebrities", "CelebrityFaces", "UnrecognizedFaces"))
    )


# --- faces --------------------------------------------------------------------------------------


def face_docs(spark, sf):
    return m.parse_detections(B.faces_json(spark, sf), "payload", "faces")


@query(
    "faces",
    """SELECT 'img/' || (vec_id // 10) AS file_uri,
        (row_number() OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) - 1)::int AS face_no,
        round(embedding[1]::double, 6) AS width, label * 5 AS age_low, label * 5 + 8 AS age_high,
        embedding[5] > 0 AS smile, CASE WHEN embedding[6] > 0 THEN 'Female' ELSE 'Male' END AS gender,
        round(embedding[11]::double, 6) AS yaw,
        CASE greatest(embedding[7], embedding[8], embedding[9]) WHEN embedding[9] THEN 'SAD'
             WHEN embedding[8] THEN 'HAPPY' ELSE 'CALM' END AS top_emotion,
        round(abs(embedding[13]::double), 6) AS confidence FROM embeddings""",
)
def faces(spark, sf):
    f = m.faces(face_docs(spark, sf))
    return f.select(
        "file_uri", "face_no", F.round("box.Width", 6).alias("width"), "age_low", "age_high", "smile",
        "gender", F.round("pose.Yaw", 6).alias("yaw"), "top_emotion", F.round("confidence", 6).alias("confidence"),
    )


@query(
    "image_age",
    """SELECT 'img/' || (vec_id // 10) AS file_uri, arg_max(label * 5, vec_id) AS age, min(label * 5) AS age_min,
       max(label * 5 + 8) AS age_max FROM embeddings GROUP BY 1""",
)
def image_age(spark, sf):
    return m.image_age(face_docs(spark, sf)).select("file_uri", "age", "age_min", "age_max")


@query(
    "celebrities",
    """SELECT 'img/' || c_custkey AS file_uri, c_acctbal >= 0 AS recognized,
        CASE WHEN c_acctbal >= 0 THEN c_name END AS name, CASE WHEN c_acctbal >= 0 THEN c_custkey::varchar END AS celebrity_id,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal / 100 END AS match_confidence,
        CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_nationkey > 12 THEN 'Female' ELSE 'Male' END END AS gender,
        CASE WHEN c_acctbal >= 0 THEN 'www.example.org/' || c_name || ' ' || c_mktsegment END AS urls,
        CASE WHEN c_acctbal < 0 THEN -c_acctbal / 100 END AS face_confidence FROM customer""",
)
def celebrities(spark, sf):
    c = m.celebrities(m.parse_detections(B.celebrities_json(spark, sf), "payload", "celebrities"))
    return c.select(
        "file_uri", "recognized", "name", "celebrity_id", "match_confidence", "gender",
        F.array_join("urls", " ").alias("urls"), F.col("face.Confidence").alias("face_confidence"),
    )


# --- text in images -----------------------------------------------------------------------------

TAG = B.TAG
DETECTIONS = rf"""
lines AS (
  SELECT page_id, unnest(b) AS line, unnest(range(0, len(b))) AS i FROM (
    SELECT page_id, list_transform(regexp_extract_all(html, '{B.BLOCK}', 1),
                                   lambda x: regexp_replace(x, '{TAG}', '', 'g')) AS b FROM pages)),
pieces AS (
  SELECT page_id, i, unnest(list_concat([line], w)) AS text, unnest(range(0, len(w) + 1)) AS j
  FROM (SELECT *, list_filter(string_split(line, ' '), lambda x: x <> '') AS w FROM lines)),
dets AS (
  SELECT page_id, text, i, CASE WHEN j = 0 THEN 'LINE' ELSE 'WORD' END AS type,
         row_number() OVER (PARTITION BY page_id ORDER BY i, j) - 1 AS id FROM pieces),
scored AS (SELECT *, 95.0::double + id % 6 AS confidence FROM dets)"""


def image_texts(spark, sf):
    return m.parse_detections(B.image_text_json(spark, sf), "payload", "image_text")


@query(
    "image_text",
    f"""WITH {DETECTIONS} SELECT 'img/' || page_id AS file_uri, id::int AS id,
        CASE WHEN type = 'WORD' THEN i ELSE -1 END::int AS parent_id, type, text, confidence FROM scored""",
)
def image_text(spark, sf):
    t = m.image_text(image_texts(spark, sf)).drop("box")
    return t.withColumn("parent_id", F.coalesce("parent_id", F.lit(-1)))


@query(
    "image_text_lines",
    f"WITH {DETECTIONS} SELECT 'img/' || page_id AS file_uri, id::int AS id, text FROM scored WHERE type = 'LINE'",
)
def image_text_lines(spark, sf):
    return m.only_lines(m.image_text(image_texts(spark, sf))).select("file_uri", "id", "text")


@query(
    "confident_text",
    f"""WITH {DETECTIONS} SELECT 'img/' || page_id AS file_uri,
        md5(coalesce(string_agg(text, '' ORDER BY id) FILTER (confidence >= 99), '')) AS all_md5,
        md5(coalesce(string_agg(text, '' ORDER BY id) FILTER (confidence >= 99 AND type = 'LINE'), '')) AS lines_md5
        FROM pages LEFT JOIN scored USING (page_id) GROUP BY page_id""",
)
def confident_text(spark, sf):
    both = m.confident_text(m.confident_text(image_texts(spark, sf), name="a"), lines_only=True, name="b")
    return both.select("file_uri", F.md5("a").alias("all_md5"), F.md5("b").alias("lines_md5"))


@query(
    "line_list",
    f"""WITH {DETECTIONS} SELECT 'img/' || page_id AS file_uri, count(i)::int AS n_lines,
        md5(coalesce(string_agg(line, chr(10) ORDER BY i), '')) AS lines_md5
        FROM pages LEFT JOIN lines USING (page_id) GROUP BY page_id""",
)
def line_list(spark, sf):
    l = m.line_list(image_texts(spark, sf))
    return l.select("file_uri", F.size("lines").alias("n_lines"), F.md5(F.array_join("lines", "\n")).alias("lines_md5"))


LINE_PII = f"""{DETECTIONS}, line_first AS (
  SELECT page_id, i, type FROM (SELECT *, row_number() OVER (PARTITION BY page_id, i ORDER BY begin_, end_, type) AS r
    FROM {pii_sql('lines', 'page_id, i', 'line')}) WHERE r = 1)"""


@query(
    "line_pii",
    f"""WITH {LINE_PII} SELECT 'img/' || page_id AS file_uri, i::int AS line_no, type AS pii_type, 1.0::double AS pii_score
    FROM line_first""",
)
def line_pii(spark, sf):
    return m.line_pii(image_texts(spark, sf)).drop("line")


# --- whole images -------------------------------------------------------------------------------


def image_documents(spark, sf):
    """The four detector documents of every image, gathered into one row."""
    kinds = {
        "moderation": B.moderation_json, "faces": B.faces_json,
        "celebrities": B.celebrities_json, "image_text": B.image_text_json,
    }
    every = None
    for kind, build in kinds.items():
        part = build(spark, sf).select("file_uri", F.lit(kind).alias("kind"), "payload")
        every = part if every is None else every.unionByName(part)
    return m.parse_image_documents(m.gather_detections(every))


IMAGES = f"""
images AS (SELECT DISTINCT n FROM (SELECT event_id // 10 AS n FROM events UNION ALL SELECT vec_id // 10 FROM embeddings
    UNION ALL SELECT c_custkey FROM customer UNION ALL SELECT page_id FROM pages)),
lab AS (SELECT event_id // 10 AS n, count(*) AS n_labels, max({CONF}) AS top, count(*) FILTER ({CONF} >= 60) AS n_strong
        FROM events GROUP BY 1),
fac AS (SELECT vec_id // 10 AS n, count(*) AS n_faces, arg_max(label * 5, vec_id) AS age FROM embeddings GROUP BY 1)"""


@query(
    "moderate_image",
    f"""WITH {DETECTIONS}, {IMAGES},
    conf AS (SELECT page_id, string_agg(text, '' ORDER BY id) FILTER (confidence >= 99) AS t FROM scored GROUP BY 1),
    hit AS (SELECT page_id, count(*) AS k FROM (SELECT page_id, unnest({TOKENS.replace('lower(text)', 'lower(t)')}) AS word FROM conf)
            WHERE word IN ('la', 'the') GROUP BY 1)
    SELECT 'img/' || n AS file_uri, coalesce(n_labels, -1)::int AS n_labels, coalesce(n_faces, -1)::int AS n_faces,
      CASE WHEN c_acctbal >= 0 THEN 1 WHEN c_acctbal < 0 THEN 0 ELSE -1 END::int AS n_celebrities,
      length(coalesce(t, ''))::int AS n_chars, CASE WHEN t <> '' THEN coalesce(k, 0) > 0 END::varchar AS flag
    FROM images LEFT JOIN lab USING (n) LEFT JOIN fac USING (n) LEFT JOIN customer ON c_custkey = n
    LEFT JOIN conf ON conf.page_id = n LEFT JOIN hit ON hit.page_id = n""",
)
def moderate_image(spark, sf):
    policy = [(1, "One", "la", "*"), (2, "Two", "the", "*")]
    r = m.moderate_image(image_documents(spark, sf), policy=policy)

    def count(array):
        return F.coalesce(F.size(array), F.lit(-1))

    return r.select(
        "file_uri", count("labels").alias("n_labels"), count("faces").alias("n_faces"),
        count("celebrities.CelebrityFaces").alias("n_celebrities"), F.length("confident_text").alias("n_chars"),
        F.col("text_checks.verdict.flag").cast("string").alias("flag"),
    )


@query(
    "image_record",
    f"""WITH {LINE_PII}, {IMAGES},
    pl AS (SELECT page_id, string_agg(type, ',' ORDER BY i) AS line_types FROM line_first GROUP BY 1),
    nl AS (SELECT page_id, count(*) AS n_lines FROM lines GROUP BY 1)
    SELECT 'img/' || n AS file_uri, CASE WHEN top < 60 THEN 'Pass' ELSE 'Human review' END AS decision,
      coalesce(n_strong, -1)::int AS n_strong, coalesce(age, -1)::int AS age, coalesce(n_lines, 0)::int AS n_lines, coalesce(line_types, '') AS line_types
    FROM images LEFT JOIN lab USING (n) LEFT JOIN fac USING (n) LEFT JOIN pl ON pl.page_id = n LEFT JOIN nl ON nl.page_id = n""",
)
def image_record(spark, sf):
    r = m.image_record(image_documents(spark, sf))
    return r.select(
        "file_uri", "decision", F.coalesce(F.size("labels"), F.lit(-1)).alias("n_strong"),
        F.coalesce("age", F.lit(-1)).alias("age"), F.size("lines").alias("n_lines"),
        F.array_join(F.transform("line_entities", lambda e: e["type"]), ",").alias("line_types"),
    )


# --- transcripts --------------------------------------------------------------------------------

JOB = "'conv-' || conv_id || '-' || (turn // 1000) AS job_name"


def transcripts(spark, sf):
    return m.parse_transcripts(B.transcript_json(spark, sf), "payload")


@query(
    "transcript_docs",
    f"""SELECT {JOB}, 'COMPLETED' AS status, count(*)::int AS n_segments, max(turn) * 5.0::double + 4.0 AS seconds
    FROM conversations GROUP BY ALL""",
)
def transcript_docs(spark, sf):
    """Transcripts written as one file each, read back by the reader."""
    folder = scratch_folder(spark, "transcripts")
    written = B.transcript_json(spark, sf).withColumn("job", F.get_json_object("payload", "$.jobName"))
    # A file costs the same however small it is, so the files are dealt by number and not by bytes.
    folders = m.write_text_objects(spread_files(written, "job"), folder, "job", "payload")
    return m.read_by_folders(spark, folders, lambda paths: m.read_transcripts(spark, paths).select(
        "job_name", "status", F.size("segments").alias("n_segments"),
        F.element_at("segments", -1)["end"].alias("seconds"),
    ))


@query(
    "toxicity_segments",
    f"""SELECT {JOB}, (turn % 1000)::int AS segment, turn * 5.0::double AS start, text,
        round(length(text) / (length(text) + 100.0::double), 6) AS toxicity, category,
        round(CASE WHEN category = 'profanity' THEN length(text) / (length(text) + 200.0::double)
             WHEN role = 'user' THEN 0.5 ELSE 0.25 END, 6) AS score
    FROM conversations, (VALUES ('profanity'), ('insult')) c(category)""",
)
def toxicity_segments(spark, sf):
    s = m.toxicity_segments(transcripts(spark, sf))
    return s.select("job_name", "segment", "start", "text", F.round("toxicity", 6).alias("toxicity"), "category",
                    F.round("score", 6).alias("score"))


@query("first_segment", f"SELECT {JOB}, arg_min(text, turn) AS text FROM conversations GROUP BY ALL")
def first_segment(spark, sf):
    return m.first_segment(transcripts(spark, sf)).select("job_name", "text")


@query(
    "full_transcript",
    f"SELECT {JOB}, md5(string_agg(text, ' ' ORDER BY turn)) AS text_md5 FROM conversations GROUP BY ALL",
)
def full_transcript(spark, sf):
    return m.full_transcript(transcripts(spark, sf)).select("job_name", F.md5("text").alias("text_md5"))


@query(
    "moderate_audio",
    f"""WITH spoken AS (SELECT {JOB}, string_agg(text, ' ' ORDER BY turn) AS text, count(*)::int AS n_segments
                       FROM conversations GROUP BY ALL),
    lang AS (SELECT job_name, arg_max(lang, (n, -k)) AS lang FROM (
        SELECT job_name, p.lang, count(*) AS n, p.k FROM (SELECT job_name, unnest({TOKENS}) AS word FROM spoken) w
        JOIN (SELECT * FROM {values([(l, w, sorted({x for x, _ in X.PROFILES}).index(l)) for l, w in X.PROFILES], 'lang, word, k')}) p
        USING (word) GROUP BY ALL) GROUP BY 1),
    hits AS (SELECT job_name, count(*) AS n FROM (SELECT job_name, unnest({TOKENS}) AS word FROM spoken) WHERE word IN ('la', 'the') GROUP BY 1)
    SELECT job_name, n_segments, coalesce(lang, 'und') <> 'en' AS pending, coalesce(n, 0) > 0 AS flag
    FROM spoken LEFT JOIN lang USING (job_name) LEFT JOIN hits USING (job_name)""",
)
def moderate_audio(spark, sf):
    policy = [(1, "One", "la", "*"), (2, "Two", "the", "*")]
    r = m.moderate_audio(transcripts(spark, sf), policy=policy, profiles=X.PROFILES)
    return r.select(
        "job_name", F.size("toxicity").alias("n_segments"),
        F.col("text_checks.analysis.pending").alias("pending"), F.col("text_checks.verdict.flag").alias("flag"),
    )


@query(
    "moderate_objects_in_full",
    f"""WITH {ROUTES}, {DETECTIONS}, {IMAGES},
    conf AS (SELECT page_id, string_agg(text, '' ORDER BY id) FILTER (confidence >= 99) AS t FROM scored GROUP BY 1),
    hit AS (SELECT page_id, count(*) AS k FROM (SELECT page_id, unnest({TOKENS.replace('lower(text)', 'lower(t)')}) AS word FROM conf)
            WHERE word IN ('la', 'the') GROUP BY 1),
    spoken AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text, count(*) AS n FROM conversations GROUP BY 1),
    said AS (SELECT conv_id, count(*) AS k FROM (SELECT conv_id, unnest({TOKENS}) AS word FROM spoken) WHERE word IN ('la', 'the') GROUP BY 1),
    wrote AS (SELECT doc_id, count(*) AS k FROM (SELECT doc_id, unnest({TOKENS}) AS word FROM documents) WHERE word IN ('la', 'the') GROUP BY 1)
    SELECT 's3://' || m.bucket || '/' || m.key AS file_uri,
      coalesce(CASE WHEN ext IN {sql_in(V.IMAGE_EXTENSIONS)} THEN n_labels END, -1)::int AS n_labels,
      CASE WHEN ext IN {sql_in(V.IMAGE_EXTENSIONS)} AND t <> '' THEN coalesce(hit.k, 0) > 0 END::varchar AS image_flag,
      coalesce(CASE WHEN ext IN {sql_in(V.AUDIO_EXTENSIONS)} THEN spoken.n END, -1)::int AS n_segments,
      CASE WHEN ext IN {sql_in(V.AUDIO_EXTENSIONS)} AND spoken.text <> '' THEN coalesce(said.k, 0) > 0 END::varchar AS audio_flag,
      CASE WHEN ext IN {sql_in(V.TEXT_EXTENSIONS)} AND d.doc_id IS NOT NULL THEN coalesce(wrote.k, 0) > 0 END::varchar AS text_flag
    FROM manifest m LEFT JOIN lab ON lab.n = m.page_id LEFT JOIN conf ON conf.page_id = m.page_id LEFT JOIN hit ON hit.page_id = m.page_id
    LEFT JOIN spoken ON spoken.conv_id = m.page_id LEFT JOIN said ON said.conv_id = m.page_id
    LEFT JOIN documents d ON d.doc_id = m.page_id LEFT JOIN wrote ON wrote.doc_id = m.page_id
    WHERE m.page_id IN (SELECT page_id FROM routes)""",
)
def moderate_objects_in_full(spark, sf):
    """Image and audio plans run on the detections of routed objects; object n is image, talk or text n."""
    policy = [(1, "One", "la", "*"), (2, "Two", "the", "*")]
    located = with_extension(m.with_uri(B.media_manifest(spark, sf)))
    routed = with_modalities(located).select("page_id", "file_uri", "modalities")

    def of(modality):
        return routed.filter(F.array_contains("modalities", modality)).drop("modalities")

    shown = image_documents(spark, sf).withColumn("page_id", F.regexp_extract("file_uri", "[0-9]+$", 0).cast("bigint"))
    images = m.moderate_image(of("image").join(shown.drop("file_uri"), "page_id").drop("page_id"), policy=policy)
    name = F.split("job_name", "-")
    talks = transcripts(spark, sf).select(
        F.get(name, F.lit(1)).try_cast("bigint").alias("page_id"),
        F.struct(F.get(name, F.lit(2)).try_cast("bigint").alias("part"), "segments").alias("p"),
    )
    # The recordings of a conversation in order.
    whole = talks.groupBy("page_id").agg(F.collect_list("p").alias("ps")).select(
        "page_id", F.flatten(F.transform(F.array_sort("ps", _by_part), lambda x: x["segments"])).alias("segments")
    )
    recordings = m.moderate_audio(of("audio").join(whole, "page_id").drop("page_id"), key="file_uri", policy=policy)
    texts = of("text").join(docs(spark, sf).withColumnRenamed("doc_id", "page_id"), "page_id").drop("page_id")
    r = m.moderate_objects(object_events(spark, sf), images=images, recordings=recordings, texts=texts, lang="lang", policy=policy)
    flag = {side: F.col(f"{side}_moderation.text_checks.verdict.flag").cast("string") for side in ("Image", "Audio")}
    return r.select(
        "file_uri",
        F.coalesce(F.size("Image_moderation.labels"), F.lit(-1)).alias("n_labels"), flag["Image"].alias("image_flag"),
        F.coalesce(F.size("Audio_moderation.toxicity"), F.lit(-1)).alias("n_segments"), flag["Audio"].alias("audio_flag"),
        F.col("Text_moderation.verdict.flag").cast("string").alias("text_flag"),
    )


def _by_part(x, y):
    return F.when(x["part"] < y["part"], -1).when(x["part"] > y["part"], 1).otherwise(0)


# --- entities in detector shape -----------------------------------------------------------------


@query(
    "pii_rows",
    f"""SELECT doc_id, type, begin_::int AS begin_offset, end_::int AS end_offset, 1.0::double AS score
    FROM {pii_sql('documents', 'doc_id')}""",
)
def pii_rows(spark, sf):
    """Entities found by patterns, written in detector shape, parsed and flattened again."""
    found = m.with_pii(load(spark, sf, "documents", spread="doc_id").select("doc_id", "text"))
    shaped = F.transform(
        "pii",
        lambda e: F.struct(e["score"].alias("Score"), e["type"].alias("Type"), e["begin"].alias("BeginOffset"),
                           e["end"].alias("EndOffset")),
    )
    as_json = found.select("doc_id", F.to_json(F.struct(shaped.alias("Entities"))).alias("payload"))
    rows = m.pii_rows(m.parse_detections(as_json, "payload", "pii"), ["doc_id"])
    return rows.select("doc_id", "type", F.col("begin").alias("begin_offset"), F.col("end").alias("end_offset"), "score")
