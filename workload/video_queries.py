"""Queries over paged video results, jobs and face search."""

from __future__ import annotations

from pyspark.sql import functions as F

import modspark as m
from modspark.operators.joins import may_match
from modspark.scratch import freed_shuffles, settle
from workload import builders as B
from workload.registry import query
from workload.tables import load

TIMED = """
first_ms AS (SELECT user_id, min((epoch_us(ts) // 1000)) AS first_ms, max((epoch_us(ts) // 1000)) AS last_ms FROM events GROUP BY 1),
timed AS (SELECT user_id::varchar AS job_id, event_id, (epoch_us(ts) // 1000) - first_ms AS ts, event_type AS name,
    least(value / 5, 100.0) AS confidence, CASE WHEN event_type = 'error' THEN '' ELSE 'activity' END AS parent,
    row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) - 1 AS position
  FROM events JOIN first_ms USING (user_id))"""
PLACE = "job_id, position // 10 AS page_no, (position % 10)::int AS item, ts"


def pages(spark, sf, **items):
    return m.parse_video_pages(B.video_pages(spark, sf, items))


@query("timeline", f"WITH {TIMED} SELECT job_id, ts, name, event_id FROM timed")
def timeline(spark, sf):
    return m.timeline(B.event_times(spark, sf), tie=("name", "event_id")).select("job_id", "ts", "name", "event_id")


@query(
    "result_page",
    f"WITH {TIMED} SELECT job_id, ts, event_id, position FROM timed WHERE position // 10 = 2",
)
def result_page(spark, sf):
    p = m.result_page(B.event_times(spark, sf), 10, 2, tie=("event_id",))
    return p.select("job_id", "ts", "event_id", "position")


@query(
    "result_page_at_one_time",
    """WITH placed AS (SELECT event_id, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS position,
      (user_id % 3)::varchar AS job_id FROM events)
    SELECT job_id, event_id, position FROM placed WHERE position // 100 = 5""",
)
def result_page_at_one_time(spark, sf):
    """Three jobs hold all detections, every one at the same time."""
    e = load(spark, sf, "events").select(
        (F.col("user_id") % 3).cast("string").alias("job_id"), "event_id", F.lit(0).cast("long").alias("ts")
    )
    return m.result_page(e, 100, 5, tie=("event_id",)).select("job_id", "event_id", "position")


@query("assemble_pages", f"WITH {TIMED} SELECT job_id, position, ts, name FROM timed")
def assemble_pages(spark, sf):
    rows = m.assemble_pages(pages(spark, sf, Labels=B.label_item()), "job_id", "page_no", "Labels")
    return rows.select("job_id", "position", "detection.Timestamp", "detection.Label.Name").toDF(
        "job_id", "position", "ts", "name"
    )


@query("video_labels", f"WITH {TIMED} SELECT {PLACE}, name, confidence FROM timed")
def video_labels(spark, sf):
    return m.video_labels(pages(spark, sf, Labels=B.label_item()))


@query("video_persons", f"WITH {TIMED} SELECT {PLACE}, event_id % 7 AS person FROM timed")
def video_persons(spark, sf):
    return m.video_persons(pages(spark, sf, Persons=B.person_item()))


@query("video_moderation", f"WITH {TIMED} SELECT {PLACE}, name, parent, confidence FROM timed")
def video_moderation(spark, sf):
    return m.video_moderation(pages(spark, sf, ModerationLabels=B.moderation_item()))


@query("video_faces", f"WITH {TIMED} SELECT {PLACE}, confidence, floor(confidence)::int AS age_low FROM timed")
def video_faces(spark, sf):
    f = m.video_faces(pages(spark, sf, Faces=B.face_item()))
    return f.withColumn("age_low", F.col("face.AgeRange.Low")).drop("face")


@query(
    "video_face_matches",
    f"""WITH {TIMED}, matches AS (
      SELECT event_id, name || '-a' AS face_id, round(confidence, 6) AS similarity FROM timed WHERE name IN ('purchase', 'view')
      UNION ALL SELECT event_id, name || '-b', round(confidence / 2, 6) FROM timed WHERE name = 'purchase')
    SELECT {PLACE}, event_id % 7 AS person, face_id, similarity FROM timed LEFT JOIN matches USING (event_id)""",
)
def video_face_matches(spark, sf):
    f = m.video_face_matches(pages(spark, sf, Persons=B.person_item()))
    return f.withColumn("similarity", F.round("similarity", 6))


@query("video_celebrities", f"WITH {TIMED} SELECT {PLACE}, 'Celebrity ' || name AS name FROM timed")
def video_celebrities(spark, sf):
    return m.video_celebrities(pages(spark, sf, Celebrities=B.celebrity_item()))


@query(
    "video_metadata",
    """SELECT user_id::varchar AS job_id, 'h264' AS codec, max((epoch_us(ts) // 1000)) - min((epoch_us(ts) // 1000)) AS duration_ms,
       'QuickTime / MOV' AS format, 29.97::double AS frame_rate FROM events GROUP BY user_id""",
)
def video_metadata(spark, sf):
    return m.video_metadata(pages(spark, sf, Labels=B.label_item()))


MATCHES = """matches AS (
      SELECT event_id, name || '-a' AS face_id, round(confidence, 6) AS similarity FROM timed WHERE name IN ('purchase', 'view')
      UNION ALL SELECT event_id, name || '-b', round(confidence / 2, 6) FROM timed WHERE name = 'purchase')"""
VIDEO_ROWS = f"""WITH {TIMED}, {MATCHES}
    SELECT {PLACE}, position, 'labels' AS kind, name, NULL AS parent, confidence, -1::bigint AS person, -1 AS age_low,
      NULL AS face_id, NULL::double AS similarity FROM timed
    UNION ALL SELECT {PLACE}, position, 'moderation', name, parent, confidence, -1, -1, NULL, NULL FROM timed
    UNION ALL SELECT {PLACE}, position, 'faces', NULL, NULL, confidence, -1, floor(confidence)::int, NULL, NULL FROM timed
    UNION ALL SELECT {PLACE}, position, 'persons', NULL, NULL, NULL, event_id % 7, -1, NULL, NULL FROM timed
    UNION ALL SELECT {PLACE}, position, 'celebrities', 'Celebrity ' || name, NULL, NULL, -1, -1, NULL, NULL FROM timed
    UNION ALL SELECT {PLACE}, position, 'face_matches', NULL, NULL, NULL, event_id % 7, -1, face_id, similarity
      FROM timed LEFT JOIN matches USING (event_id)"""


def all_analyses(spark, sf, numbered):
    raw = B.video_pages(spark, sf, {
        "Labels": B.label_item(), "ModerationLabels": B.moderation_item(), "Faces": B.face_item(),
        "Persons": B.person_item(), "Celebrities": B.celebrity_item(),
    })
    kinds = ["labels", "moderation", "faces", "persons", "celebrities", "face_matches"]
    v = m.moderate_video(m.parse_video_pages(raw, columns=m.page_columns(kinds)), kinds, numbered)
    return v.select(
        "job_id", "page_no", "item", *(["position"] if numbered else []), "ts", "kind", "name", "parent", "confidence",
        F.coalesce("person", F.lit(-1)).cast("bigint").alias("person"),
        F.coalesce("face.AgeRange.Low", F.lit(-1)).alias("age_low"), "face_id", F.round("similarity", 6).alias("similarity"),
    )


@query("moderate_video", f"SELECT * EXCLUDE (position) FROM ({VIDEO_ROWS})")
def moderate_video(spark, sf):
    """All six analyses of every page: one scan, one parse."""
    return all_analyses(spark, sf, False)


@query("moderate_video_numbered", VIDEO_ROWS)
def moderate_video_numbered(spark, sf):
    return all_analyses(spark, sf, True)


# --- jobs ---------------------------------------------------------------------------------------

STATUS = """CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'IN_PROGRESS' ELSE 'COMPLETED' END"""
JOBS = f"""
notices AS (SELECT event_id, user_id || ':' || event_type AS job_id, {STATUS} AS status FROM events),
jobs AS (SELECT user_id || ':' || event_type AS job_id, min(event_id) AS submitted_as FROM events WHERE value >= 100 GROUP BY 1)"""


def notices(spark, sf):
    return m.parse_job_notices(B.job_notice_json(spark, sf))


@query("job_notices", f"WITH {JOBS} SELECT * FROM notices")
def job_notices(spark, sf):
    return notices(spark, sf)


@query(
    "finished_jobs",
    f"""WITH {JOBS} SELECT event_id, job_id, status, status = 'COMPLETED' AS completed FROM notices
    WHERE status IN ('COMPLETED', 'FAILED')""",
)
def finished_jobs(spark, sf):
    completed, failed = m.split_finished_jobs(notices(spark, sf))
    return completed.withColumn("completed", F.lit(True)).unionByName(
        failed.withColumn("completed", F.lit(False))
    )


@query("match_jobs", f"WITH {JOBS} SELECT * FROM notices JOIN jobs USING (job_id)")
def match_jobs(spark, sf):
    return m.match_jobs(B.submitted_jobs(spark, sf), notices(spark, sf), spread_by=["event_id"])


@query("unmatched_notices", f"WITH {JOBS} SELECT * FROM notices WHERE job_id NOT IN (SELECT job_id FROM jobs)")
def unmatched_notices(spark, sf):
    return m.unmatched_notices(B.submitted_jobs(spark, sf), notices(spark, sf), spread_by=["event_id"])


# --- faces --------------------------------------------------------------------------------------

FACES = """
unit AS (SELECT vec_id, embedding::double[] AS v FROM embeddings),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS face_id, round(list_cosine_similarity(q.v, c.v), 6) AS similarity
          FROM unit q JOIN unit c ON q.vec_id <> c.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, face_id)::int AS rank
         FROM pairs WHERE similarity >= 0.3)"""


def collection(spark, sf):
    return load(spark, sf, "embeddings").select(F.col("vec_id").alias("face_id"), "embedding")


@query("face_search", f"WITH {FACES} SELECT * FROM near WHERE rank <= 3")
def face_search(spark, sf):
    c = collection(spark, sf)
    return m.face_search(c, c, min_similarity=0.3, k=3, exclude_self=True)


@query("face_search_by_cells", f"WITH {FACES} SELECT * FROM near WHERE rank <= 3")
def face_search_by_cells(spark, sf):
    """The plan for two large sides, forced by a query limit of 0."""
    c = collection(spark, sf)
    return m.face_search(
        c, c, min_similarity=0.3, k=3, exclude_self=True, query_limit=0, pivots=16, block_rows=100
    )


@query(
    "face_search_approximate",
    f"""WITH {FACES} SELECT count(*)::bigint AS n_exact, true AS recall_reached, 0::bigint AS n_wrong FROM near WHERE rank <= 3""",
)
def face_search_approximate(spark, sf):
    """Found by hash tables against found exactly: at least 95 %, and nothing that is not a match."""
    c = collection(spark, sf)
    with freed_shuffles(spark):
        best = settle(m.face_search(c, c, min_similarity=0.3, k=3, exclude_self=True)).withColumn("exact", F.lit(1))
    near = m.face_search(c, c, min_similarity=0.3, k=10**6, exclude_self=True, approximate=True, hash_bits=4)
    pairs = near.select("query_id", "face_id", "similarity", F.lit(1).alias("found"))
    # All pairs are found and looked at; those that are right but not among the best count nowhere below.
    pairs = may_match(pairs, best, ["query_id", "face_id"], F.col("similarity") < 0.3)
    both = best.drop("similarity").join(pairs, ["query_id", "face_id"], "full")
    n = F.count("exact")
    return both.agg(
        n.alias("n_exact"), (100 * F.count(F.when(F.col("exact").isNotNull(), F.col("found"))) >= 95 * n).alias("recall_reached"),
        F.count(F.when(F.col("similarity") < 0.3, 1)).alias("n_wrong"),
    )


@query(
    "face_search_cost",
    "SELECT count(*)::bigint AS faces, count(*)::bigint AS queries, true AS within FROM embeddings WHERE embedding IS NOT NULL",
)
def face_search_cost(spark, sf):
    """The exact search by leaves never meets a face twice, and knows its cost beforehand."""
    c = collection(spark, sf)
    cost = m.face_search_cost(c, c, min_similarity=0.3)
    return cost.select("faces", "queries", (F.col("share") <= 1).alias("within"))
