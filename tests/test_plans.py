import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import modspark as m
from modspark.scratch import scratch_folder, settle
from modspark.sources import objects
from workload import detection_queries, object_queries, text_queries  # noqa: F401  (register their queries)
from workload.registry import QUERIES


def event(key, sequencer, when="2024-01-01T00:00:00.000Z"):
    return {"eventTime": when, "s3": {"bucket": {"name": "box"}, "object": {"key": key, "size": 3, "eTag": "e", "sequencer": sequencer}}}


def write_events(path, name, *records):
    path.mkdir(exist_ok=True)
    (path / name).write_text(json.dumps({"Records": list(records)}))


def test_events_give_every_record_and_decode_keys(spark, tmp_path):
    write_events(tmp_path / "in", "a.json", event("in/a+b%20c.txt", "1"), event("in/50%.txt", "2"))
    got = {r["sequencer"]: r["key"] for r in m.read_object_events(spark, str(tmp_path / "in")).collect()}
    assert got == {"1": "in/a b c.txt", "2": "in/50%.txt"}
    raw = m.read_object_events(spark, str(tmp_path / "in"), decode_keys=False)
    assert {r["key"] for r in raw.collect()} == {"in/a+b%20c.txt", "in/50%.txt"}


def test_text_and_media_readers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("三", encoding="utf-8")
    assert sorted(r["text"] for r in m.read_text_objects(spark, str(tmp_path)).collect()) == ["one\ntwo\n", "三"]
    media = m.list_media_objects(spark, str(tmp_path))
    assert sorted(r["size"] for r in media.collect()) == [3, 8]
    assert "content" not in media._jdf.queryExecution().executedPlan().toString()


def test_text_objects_are_whole_in_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(objects, "FILES_IN_FOLDER", 2)
    monkeypatch.setattr(objects, "FILES_AT_ONCE", 3)
    texts = [(-5, "one\r\ntwo\n"), (1, ""), (2, None), (3, "\ufeff三\0"), (4, "a"), (4, "a"), (4, "b"), (None, "c")]
    df = spark.createDataFrame(texts, "k INT, t STRING").repartition(2, "k")
    folder = scratch_folder(spark, "texts")
    folders = m.write_text_objects(df, folder, "k", "t")
    assert sum(n for _, n in folders) == len(texts) and max(n for _, n in folders) == 2 and len(folders) <= 5
    want = sorted((str(k), (t or "") + "\n") for k, t in texts)
    key = F.regexp_extract("file_uri", "k=(-?[0-9]+)-", 1)
    for compressed in (True, False):
        asked = []
        rows = m.read_by_folders(spark, folders, lambda paths: (
            asked.append(paths) or m.read_text_objects(spark, paths, compressed).select(key.alias("k"), "text")))
        assert sorted((r["k"] or "None", r["text"]) for r in rows.collect()) == want
        assert len(asked) > 1 and sorted(sum(asked, [])) == [f for f, _ in folders]
    # A second attempt of a task finds its files in place and leaves nothing that a reader sees.
    again = m.write_text_objects(df, folder, "k", "t")
    assert again == folders and m.read_text_objects(spark, folder).count() == len(texts)


def test_no_text_objects_and_odd_files(spark, tmp_path):
    none = spark.createDataFrame([], "k INT, t STRING")
    folders = m.write_text_objects(none, scratch_folder(spark, "texts"), "k", "t")
    assert m.read_by_folders(spark, folders, lambda paths: m.read_text_objects(spark, paths)).count() == 0
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "bytes.txt").write_bytes(b"\xff\xfe a\r\n")
    got = [sorted(bytes(r["b"]) for r in m.read_text_objects(spark, str(tmp_path), c).select(
        F.col("text").cast("binary").alias("b")).collect()) for c in (True, False)]
    assert got == [[b"\xff\xfe a\r\n"]] * 2


def test_text_objects_in_a_store_that_only_spark_reads(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.texts.link./box", f"file://{tmp_path}")
    df = spark.createDataFrame([(-1, "one"), (2, None)], "k INT, t STRING")
    folders = m.write_text_objects(df, "viewfs://texts/box/out", "k", "t")
    rows = m.read_by_folders(spark, folders, lambda paths: m.read_text_objects(spark, paths).select(
        F.regexp_extract("file_uri", "k=(-?[0-9]+)", 1).alias("k"), "text"))
    assert sorted(map(tuple, rows.collect())) == [("-1", "one\n"), ("2", "\n")]


@pytest.mark.parametrize("name, module, table", [
    ("text_objects", "text_queries", "documents"),
    ("media_objects", "object_queries", "pages"),
    ("transcript_docs", "detection_queries", "conversations"),
])
def test_rows_become_files_without_a_folder_each(spark, sf, monkeypatch, name, module, table):
    made = []
    monkeypatch.setattr(f"workload.{module}.scratch_folder", lambda s, n: made.append(scratch_folder(s, n)) or made[0])
    key = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}[table]
    rows = spark.read.parquet(f"{sf}/{table}.parquet").select(key).distinct().count()
    assert QUERIES[name](spark, sf).count() == rows
    files = [d for d, _, names in os.walk(made[0]) for f in names if f.endswith(".txt")]
    assert len(files) == rows and len(set(files)) <= 16


def test_moderate_text_scores_translation_or_source(spark):
    df = spark.createDataFrame(
        [(1, "I hate rainy days, my name is Clara", "en"), (2, "Ich hasse das", "de"), (3, "Das ist schlecht", "de")],
        "doc_id INT, text STRING, lang STRING")
    t = spark.createDataFrame([("Ich hasse das", "I hate that, smoking")], "s STRING, english STRING")
    t = t.select(F.sha2("s", 256).alias("text_hash"), "english")
    got = {r["doc_id"]: r for r in m.moderate_text(df, lang="lang", translations=t, id_col="doc_id").collect()}
    assert [got[i]["sentiment"] for i in (1, 2, 3)] == ["NEGATIVE"] * 3
    assert [got[i]["offset_basis"] for i in (1, 2, 3)] == ["source", "english", "source"]
    assert [got[i]["pending"] for i in (1, 2, 3)] == [False, False, True]
    assert got[2]["category"] == "Tobacco" and got[1]["pii"][0]["type"] == "NAME"


def test_moderate_text_is_one_pass(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    for frame in (m.moderate_text(d, lang="lang"), m.moderate_text(d.drop("lang"))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1


def test_language_is_found_when_not_given(spark):
    df = spark.createDataFrame([(1, "the world is bad"), (2, "die Welt ist schlecht und der")], "doc_id INT, text STRING")
    got = {r["doc_id"]: (r["lang"], r["sentiment"]) for r in m.moderate_text(df).collect()}
    assert got == {1: ("en", "NEGATIVE"), 2: ("de", "NEGATIVE")}


def images(spark):
    docs = [
        ("s3://box/a.jpg", "moderation", {"ModerationLabels": [{"Name": "Smoking", "Confidence": 61.5, "ParentName": "Tobacco"},
                                                          {"Name": "Weak", "Confidence": 10.0, "ParentName": ""}]}),
        ("s3://box/a.jpg", "image_text", {"TextDetections": [{"DetectedText": "no smoking a@b.com", "Type": "LINE", "Id": 0, "Confidence": 99.5}]}),
        ("s3://box/b.png", "moderation", {"ModerationLabels": []}),
        ("s3://box/b.png", "faces", {"FaceDetails": [{"AgeRange": {"Low": 9, "High": 12}}]}),
    ]
    rows = [(u, k, json.dumps(d)) for u, k, d in docs]
    return m.parse_image_documents(m.gather_detections(spark.createDataFrame(rows, "file_uri STRING, kind STRING, payload STRING")))


def test_gathering_takes_the_newest_document(spark):
    df = spark.createDataFrame([("u", "faces", "old", 1), ("u", "faces", "new", 2)], "file_uri STRING, kind STRING, payload STRING, v INT")
    assert m.gather_detections(df, order_by="v").head()["faces"] == "new"


def test_images(spark):
    got = {r["file_uri"]: r for r in m.moderate_image(images(spark)).collect()}
    a, b = got["s3://box/a.jpg"], got["s3://box/b.png"]
    assert a["confident_text"] == "no smoking a@b.com" and b["confident_text"] == "" and b["text_checks"] is None
    assert a["text_checks"]["analysis"]["pii"][0]["type"] == "EMAIL"
    records = {r["file_uri"]: r for r in m.image_record(images(spark)).collect()}
    a, b = records["s3://box/a.jpg"], records["s3://box/b.png"]
    assert (a["decision"], b["decision"], a["age"], b["age"]) == ("Human review", "Pass", None, 9)
    assert [(l["name"], l["confidence"]) for l in a["labels"]] == [("Smoking", Decimal("61.5"))]
    assert a["lines"] == ["no smoking a@b.com"] and [e["type"] for e in a["line_entities"]] == ["EMAIL"]


def sides(spark):
    texts = spark.createDataFrame([("s3://box/c.txt", "I hate smoking")], "file_uri STRING, text STRING")
    talk = spark.createDataFrame([("s3://box/d.mp4", "spoken")], "file_uri STRING, spoken STRING")
    return {"images": m.moderate_image(images(spark)), "texts": texts, "recordings": talk}


def test_objects_get_the_result_of_their_modality(spark, tmp_path):
    write_events(tmp_path / "in", "a.json", event("a.jpg", "1"), event("c.txt", "1"), event("d.mp4", "1"),
                 event("x.bin", "1"), event("b.png", "1"), event("c.txt", "2"), event("missing.txt", "1"))
    events = m.read_object_events(spark, str(tmp_path / "in"))
    got = {r["key"]: r for r in m.moderate_objects(events, **sides(spark)).collect()}
    assert set(got) == {"a.jpg", "b.png", "c.txt", "d.mp4", "missing.txt"}
    assert got["a.jpg"]["Image_moderation"]["labels"][0]["Name"] == "Smoking" and got["a.jpg"]["Text_moderation"] is None
    assert got["c.txt"]["Text_moderation"]["verdict"]["flag"] is True or got["c.txt"]["Text_moderation"]["analysis"]["pending"]
    assert got["c.txt"]["sequencer"] == "2" and got["d.mp4"]["Audio_moderation"]["spoken"] == "spoken"
    assert got["d.mp4"]["modalities"] == ["video", "audio"]
    assert got["missing.txt"]["Text_moderation"] is None


def test_result_documents_skip_objects_without_result(spark, tmp_path):
    write_events(tmp_path / "in", "a.json", event("a.jpg", "1"), event("missing.txt", "1"), event("c.txt", "1"))
    out = m.moderate_objects(m.read_object_events(spark, str(tmp_path / "in")), **sides(spark))
    m.write_results(m.with_result_key(out), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert {(r["key"], r["modality"]) for r in back.collect()} == {("a.jpg", "image"), ("c.txt", "text")}
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"modality=image", "modality=text"}


def test_store_keeps_the_latest_record_whole(spark, tmp_path):
    store, schema = str(tmp_path / "store"), "k STRING, v INT, note STRING"
    put = lambda rows, **o: m.upsert_latest(spark.createDataFrame(rows, schema), store, "k", ["v"], **o)
    put([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")])
    second = put([("a", 3, None), ("b", 0, "late")])
    want = {("a", 3, None), ("b", 1, "x")}
    assert {tuple(r) for r in m.read_latest(spark, store, "k", ["v"]).collect()} == want
    assert put([("a", 3, None), ("b", 0, "late")], writer=second) == second
    assert spark.read.parquet(store).count() == 4
    assert {tuple(r) for r in m.read_latest(spark, store, "k").collect()} == {("a", 3, None), ("b", 0, "late")}
    m.compact_store(spark, store, str(tmp_path / "compact"), "k", ["v"])
    assert {tuple(r) for r in m.read_latest(spark, str(tmp_path / "compact"), "k", ["v"]).collect()} == want


def test_store_compacts_only_touched_buckets_and_reads_only_live_files(spark, tmp_path):
    from modspark.sources.buckets import manifest

    store = str(tmp_path / "store")

    def put(rows, **options):
        return m.upsert_latest(spark.createDataFrame(rows, "k STRING, at INT, v STRING"), store, "k", ["at"], **options)

    def current():
        return {r["k"]: r["v"] for r in m.read_latest(spark, store, "k", ["at"]).collect()}

    put([(f"k{i}", 1, "first") for i in range(200)])
    assert len(m.compact_buckets(spark, store, "k", ["at"], buckets=8)) == 8
    want = {f"k{i}": "first" for i in range(200)}
    plain = m.read_latest(spark, store, "k", ["at"])
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: r["v"] for r in plain.collect()} == want
    # One newer record, one older than the stored one, one new key.
    put([("k1", 2, "newer"), ("k2", 0, "older"), ("new", 1, "new")], writer="w", batch_id=3)
    want |= {"k1": "newer", "new": "new"}
    assert current() == want
    before = manifest(spark, store)
    touched = m.compact_buckets(spark, store, "k", ["at"])
    after = manifest(spark, store)
    assert 1 <= len(touched) <= 3 and all(after.live[b] == (1 if b in touched else 0) for b in after.live)
    assert before.live.keys() == after.live.keys() and ("w", "3") in after.puts
    assert current() == want and m.compact_buckets(spark, store, "k", ["at"]) == []
    opened = {f.split("_base/")[1].rsplit("/", 1)[0] for f in m.read_latest(spark, store, "k", ["at"]).inputFiles()}
    assert opened == {f"version={v}/bucket={b}" for b, v in after.live.items()}
    put([("k1", 2, "newer"), ("k2", 0, "older"), ("new", 1, "new")], writer="w", batch_id=3)  # replayed
    assert current() == want
    # A put with another column, and a manifest that was not finished.
    m.upsert_latest(spark.createDataFrame([("k5", 9, "wide", 1)], "k STRING, at INT, v STRING, extra INT"), store, "k", ["at"])
    (tmp_path / "store" / "_manifest" / "version=7").mkdir()
    assert current() == want | {"k5": "wide"}
    assert m.compact_buckets(spark, store, "k", ["at"]) and current() == want | {"k5": "wide"}


def test_safety_records(spark):
    df = spark.createDataFrame([(1, "pills pills pills", "en")], "doc_id INT, text STRING, lang STRING")
    assert tuple(m.safety_record(df).head()) == (1, "Unsafe", "Med", "found: pills")
    replies = spark.createDataFrame([(1, 'x\nResult:"Safe"\nDegree of harm:"None"\nExplanation: fine')], "doc_id INT, r STRING")
    assert tuple(m.safety_record(replies, replies="r").head()) == (1, "Safe", "None", "fine")


def test_scratch_folder_follows_the_session(spark):
    assert scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    df = spark.range(5)
    assert sorted(r["id"] for r in settle(df).collect()) == list(range(5))


def read_stream_result(spark, path):
    return {r["key"]: r for r in m.read_latest(spark, str(path / "store"), "file_uri", ["sequencer"]).collect()}


def test_stream_equals_batch_and_survives_redelivery(spark, tmp_path):
    inbox = tmp_path / "in"
    write_events(inbox, "a.json", event("a.jpg", "1"), event("c.txt", "1"), event("c.txt", "1"))

    def run():
        m.stream_moderation(
            spark, str(inbox), str(tmp_path / "store"), str(tmp_path / "ckpt"), sides=lambda _: sides(spark)
        ).awaitTermination()

    run()
    first = read_stream_result(spark, tmp_path)
    write_events(inbox, "b.json", event("c.txt", "1"), event("b.png", "7"), event("z.bin", "1"))
    run()
    got = read_stream_result(spark, tmp_path)
    assert set(first) == {"a.jpg", "c.txt"} and set(got) == {"a.jpg", "c.txt", "b.png"}
    batch = {r["key"]: r for r in m.moderate_objects(m.read_object_events(spark, str(inbox)), **sides(spark)).collect()}
    assert {k: (r["Text_moderation"], r["Image_moderation"]) for k, r in got.items()} == {
        k: (r["Text_moderation"], r["Image_moderation"]) for k, r in batch.items()}
    # A query with a fresh checkpoint writes next to what is there and replaces nothing.
    m.stream_moderation(
        spark, str(inbox), str(tmp_path / "store"), str(tmp_path / "other"), sides=lambda _: sides(spark)
    ).awaitTermination()
    assert len({p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("writer=")}) == 2
    again = read_stream_result(spark, tmp_path)
    assert {k: r["Text_moderation"] for k, r in again.items()} == {k: r["Text_moderation"] for k, r in got.items()}


def test_notices_read_and_matched_in_batch_and_stream(spark, tmp_path):
    def notice(job, status, sent):
        return json.dumps({"Body": json.dumps({"Message": json.dumps({"JobId": job, "Status": status})}), "sent_at": sent})

    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "a.json").write_text("\n".join([
        notice("a", "COMPLETED", "2024-01-01T01:00:00Z"), notice("b", "FAILED", "2024-01-01T02:00:00Z"),
        notice("unknown", "COMPLETED", "2024-01-01T02:00:00Z"), notice("a", "COMPLETED", "2024-01-01T23:00:00Z")]))
    jobs = spark.createDataFrame([("a", "2024-01-01 00:30:00"), ("b", "2024-01-01 00:30:00")], "job_id STRING, t STRING")
    jobs = jobs.select("job_id", F.to_timestamp("t").alias("submitted_at"))
    notices = m.read_job_notices(spark, str(tmp_path / "n"), extra_fields="sent_at TIMESTAMP")
    assert m.match_jobs(jobs, notices).count() == 3
    assert [r["job_id"] for r in m.unmatched_notices(jobs, notices).collect()] == ["unknown"]

    jobs.write.parquet(str(tmp_path / "jobs"))
    left = spark.readStream.schema(jobs.schema).parquet(str(tmp_path / "jobs"))
    right = m.read_job_notices(spark, str(tmp_path / "n"), True, "sent_at TIMESTAMP")
    out = m.stream_match_jobs(left, right, watermark="2 days", max_wait="6 hours")
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
        str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["job_id"], r["status"]) for r in got) == [("a", "COMPLETED"), ("b", "FAILED")]


def test_a_hot_job_of_the_stream_is_spread_over_parts(spark, tmp_path):
    start = "TIMESTAMP'2024-01-01 00:00:00'"
    jobs = spark.sql(f"SELECT 'hot' AS job_id, {start} AS submitted_at, 1 AS s")
    notices = spark.range(400).selectExpr(
        "IF(id % 4 = 0, 'lost', 'hot') AS job_id", "'COMPLETED' AS status", f"{start} + make_dt_interval(0, 0, 0, id) AS sent_at", "id")
    late = spark.sql(f"SELECT 'end' AS job_id, 'COMPLETED' AS status, {start} + INTERVAL 5 DAYS AS sent_at, -1L AS id")
    end = spark.sql(f"SELECT 'end' AS job_id, {start} + INTERVAL 5 DAYS AS submitted_at, 2 AS s")
    jobs.union(end).write.parquet(str(tmp_path / "j"))
    notices.union(late).write.parquet(str(tmp_path / "n"))
    left, right = (spark.readStream.schema(spark.read.parquet(str(tmp_path / x)).schema).parquet(str(tmp_path / x)) for x in "jn")
    out = m.stream_match_jobs(left, right, how="right_outer", salts=4, spread_by=["id"])
    assert "_part" not in out.columns
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
        str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["id"] for r in got if r["s"] == 1) == [i for i in range(400) if i % 4]
    assert sorted(r["id"] for r in got if r["s"] is None) == [i for i in range(400) if i % 4 == 0]
    with pytest.raises(ValueError):
        m.stream_match_jobs(left, right, how="left_outer")


@pytest.mark.parametrize("small", [True, False])
def test_matching_with_a_hot_job(spark, monkeypatch, small):
    monkeypatch.setattr("modspark.operators.joins.is_small", lambda *_, **__: small)
    notices = spark.range(300).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("j"), "id")).alias("job_id"), "id")
    jobs = spark.createDataFrame([("hot",), ("j1",), ("idle",)], "job_id STRING").withColumn("s", F.lit(1))
    assert m.match_jobs(jobs, notices, spread_by=["id"]).groupBy("job_id").count().orderBy("job_id").collect() == [("hot", 100), ("j1", 1)]
    assert m.unmatched_notices(jobs, notices, spread_by=["id"]).count() == 199
    assert m.match_jobs(jobs, notices, "left", spread_by=["id"]).count() == 300


def test_documents_are_not_sorted_before_their_shuffle(spark):
    df = spark.createDataFrame([(f"u{i % 9}", k, f"{k}{i}", i) for i in range(90) for k in ("faces", "moderation")],
                               "file_uri STRING, kind STRING, payload STRING, v INT")
    for order_by in (None, "v"):
        got = m.gather_detections(df, order_by=order_by)
        above, below = got._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)
        assert "Aggregate" in above and "Aggregate" not in below and "Sort" not in below and "Exchange" not in below
        best = max if order_by is None else (lambda texts: texts[-1])
        want = {f"u{u}": best([f"faces{i}" for i in range(u, 90, 9)]) for u in range(9)}
        assert {r["file_uri"]: r["faces"] for r in got.collect()} == want


def test_small_files_are_written_by_many_tasks(spark, sf):
    from workload import builders
    from workload.tables import spread_files

    made = builders.transcript_json(spark, sf)
    spread = spread_files(made.withColumn("job", F.get_json_object("payload", "$.jobName")), "job")
    tasks = spread.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4 and spread.count() == made.count()


def brute(q, c, floor, k, exclude):
    import numpy as np

    def unit(rows):
        x = np.array([r[1] for r in rows])
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    sim = np.round(unit(q) @ unit(c).T, 6)
    out = set()
    for i, (qid, _) in enumerate(q):
        order = sorted((-sim[i, j], cid) for j, (cid, _) in enumerate(c) if sim[i, j] >= floor and not (exclude and cid == qid))
        out |= {(qid, cid, float(-s), n) for n, (s, cid) in enumerate(order[:k], 1)}
    return out


@pytest.mark.parametrize("floor", [0.95, 0.5, -1.0])
@pytest.mark.parametrize("limit", [1000, 0])
def test_face_search_equals_brute_force(spark, floor, limit):
    import numpy as np

    rng = np.random.default_rng(7)
    centers = rng.normal(size=(5, 8))
    # A third of the collection is one face, copied.
    faces = [(i, (centers[0] if i % 3 == 0 else centers[i % 5] + 0.3 * rng.normal(size=8)).tolist()) for i in range(200)]
    queries = faces[:60]
    schema = "face_id INT, embedding ARRAY<DOUBLE>"
    q, c = spark.createDataFrame(queries, schema), spark.createDataFrame(faces, schema)
    got = m.face_search(q, c, floor, 4, exclude_self=True, query_limit=limit, pivots=12, block_rows=20)
    assert {tuple(r) for r in got.collect()} == brute(queries, faces, floor, 4, True)


def test_face_search_with_an_empty_side(spark):
    schema = "face_id INT, embedding ARRAY<DOUBLE>"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, [1.0, 0.0])], schema)
    for q, c in ((none, one), (one, none)):
        for limit in (10, 0):
            assert m.face_search(q, c, 0.1, 2, query_limit=limit).count() == 0


def clustered(spark, n, seed, spread=0.1, dims=16):
    import numpy as np

    rng = np.random.default_rng(seed)
    centers = np.random.default_rng(1).normal(size=(40, dims))
    v = centers[rng.integers(0, 40, n)] + spread * rng.normal(size=(n, dims))
    return spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "face_id INT, embedding ARRAY<DOUBLE>")


def test_face_search_meets_a_smaller_share_of_more_faces(spark):
    q = clustered(spark, 100, 2)
    costs = [m.face_search_cost(q, clustered(spark, n, 3), 0.9).head() for n in (400, 1600, 6400)]
    assert [c["faces"] for c in costs] == [400, 1600, 6400] and costs[0]["leaves"] < costs[2]["leaves"]
    assert costs[0]["share"] > costs[1]["share"] > costs[2]["share"] and costs[2]["share"] < 0.15
    faces = clustered(spark, 1600, 3)
    wide = m.face_search(q, faces, 0.9, 5, query_limit=0)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, m.face_search(q, faces, 0.9, 5).collect()))


def test_small_blocks_copy_no_rows(spark, monkeypatch):
    from modspark.operators import matching

    moved, deal = [], matching.I.dealt
    monkeypatch.setattr(matching.I, "dealt", lambda *a: [moved.append(side.count()) or side for side in deal(*a)])
    faces = clustered(spark, 600, 3)
    got = m.face_search(faces, faces, -1.0, 2, query_limit=0, pivots=2, block_rows=10).collect()
    assert len(got) == 1200 and moved[0] <= 2 * 600 and moved[1] == 600


def test_a_low_floor_compares_groups_of_all_faces(spark, monkeypatch):
    from modspark.operators import face_index, matching

    faces = clustered(spark, 1600, 3)
    low, high = (face_index.tree_plan(*matching._sides(faces, faces, "face_id", "embedding")[:2], floor, None, 16) for floor in (0.0, 0.95))
    assert face_index.grid_is_cheaper(low, 500) and not face_index.grid_is_cheaper(high, 20)
    seen = {r["cell"]: r["count"] for r in high.visits().groupBy("cell").count().collect()}
    assert seen == {r["cell"]: r["q"] for r in high.met.collect()} and high.n_queries == 1600
    want = sorted(map(tuple, m.face_search(faces, faces, 0.0, 3).collect()))
    monkeypatch.setattr(matching, "GROUP_NUMBERS", 16 * 500)  # several groups a side
    monkeypatch.setattr(face_index.TreePlan, "visits", None)  # vectors are not repeated for each leaf
    assert sorted(map(tuple, m.face_search(faces, faces, 0.0, 3, query_limit=0, block_rows=90).collect())) == want


def test_ranks_are_sorted_not_listed(spark):
    plan = m.face_search(clustered(spark, 50, 1), clustered(spark, 50, 1), 0.3, 10**6)._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "Window" in plan


@pytest.mark.parametrize(("floor", "bits"), [(0.9, None), (0.6, 5)])
def test_hash_tables_find_what_they_promise(spark, floor, bits):
    q, c = clustered(spark, 200, 4, 0.5), clustered(spark, 2000, 5, 0.5)
    exact = {(r["query_id"], r["face_id"]): r["similarity"] for r in m.face_search(q, c, floor, 10**6).collect()}
    got = [(r["query_id"], r["face_id"], r["similarity"]) for r in m.face_search(q, c, floor, 10**6, approximate=True, block_rows=200, hash_bits=bits).collect()]
    found = {(x, y): s for x, y, s in got}
    assert len(got) == len(found) and len(exact) > 500
    assert all(abs(exact[pair] - s) < 2e-6 for pair, s in found.items())
    assert len(found) >= 0.95 * len(exact)


@pytest.mark.parametrize(("floor", "bits", "k"), [(0.3, 4, 10**6), (0.3, 4, 3), (0.8, None, 10**6), (0.6, 1, 7), (-1.0, None, 10**6)])
def test_a_grid_finds_the_pairs_of_the_hash_tables_without_moving_them(spark, monkeypatch, floor, bits, k):
    from modspark.operators import face_index, matching

    q, c = clustered(spark, 150, 4, 0.5), clustered(spark, 700, 5, 0.5)
    odd = [(9001, None), (9002, [0.0] * 16), (2**31 - 1, [0.3] * 16), (7, [1.0] * 16), (7, [-1.0] * 16), (7, [1.0] * 16)]
    c = c.unionByName(spark.createDataFrame(odd, c.schema))
    found = {}
    for grid in (True, False):
        monkeypatch.setattr(face_index, "hash_grid_is_cheaper", lambda *_, grid=grid: grid, raising=False)
        got = m.face_search(q, c, floor, k, approximate=True, hash_bits=bits, exclude_self=True)
        found[grid] = sorted(map(tuple, got.collect()))
    assert found[True] == found[False] and len(found[True]) > 100
    monkeypatch.setattr(face_index, "hash_grid_is_cheaper", lambda *_: True, raising=False)
    monkeypatch.setattr(matching, "GROUP_NUMBERS", 16 * 60)
    monkeypatch.setattr(matching, "PRODUCT", 500)
    small = m.face_search(q, c, floor, k, approximate=True, hash_bits=bits, exclude_self=True)
    assert sorted(map(tuple, small.collect())) == found[True]
    whole = m.face_search(q, q, floor, 10**6, approximate=True, hash_bits=bits).select("query_id", "face_id", "similarity")
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan  # pairs go on where they are found


def test_rows_without_a_match_are_left_out_before_a_join(spark):
    from modspark.operators.joins import may_match

    many = spark.range(20_000).selectExpr("id AS a", "id % 7 AS b", "IF(id = 5, NULL, id / 20000) AS s")
    one = spark.createDataFrame([(i, i % 7) for i in range(0, 20_000, 50)] + [(1, 3), (None, 2)], "a long, b long")
    got = may_match(many, one, ["a", "b"], F.col("s") < 0.001)
    want = {*range(0, 20_000, 50), *range(20)} - {5}
    assert sorted(r.a for r in got.collect()) == sorted(want) and got.columns == many.columns
    assert may_match(many, one.limit(0), ["a", "b"], F.col("s") < 0.001).count() == 19
    assert may_match(many, one, ["a", "b"], F.lit(False), limit=3).count() == 20_000


def test_hash_plan_uses_more_bits_for_more_faces():
    from modspark.operators.face_index import flips, hash_plan

    plans = [hash_plan(n, 0.8, 0.95) for n in (1000, 100_000, 10_000_000)]
    met = [p.tables * p.probes / 2**p.bits for p in plans]
    assert plans[0].bits < plans[1].bits < plans[2].bits and met[0] > met[1] > met[2] and met[2] < 0.01
    assert hash_plan(1000, -1.0, 0.95).tables >= 1

    import numpy as np

    tried = flips(np.array([[0.1, 2.0, -0.2, 1.0]]), 4)[0]
    assert set(tried) == {0b0000, 0b0001, 0b0100, 0b0101}


def test_approximate_search_with_an_empty_side(spark):
    schema = "face_id INT, embedding ARRAY<DOUBLE>"
    none, one = spark.createDataFrame([(3, None)], schema), spark.createDataFrame([(1, [1.0, 0.0])], schema)
    for q, c in ((none, one), (one, none)):
        assert m.face_search(q, c, 0.1, 2, approximate=True).count() == 0
        assert m.face_search_cost(q, c).count() == 0
    assert [tuple(r) for r in m.face_search(one, one, 0.5, 2, approximate=True).collect()] == [(1, 1, 1.0, 1)]


def test_filters_on_scores_do_not_copy_the_scoring(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    scored = m.moderate_text(d)
    plain = scored._jdf.queryExecution().executedPlan().toString()
    strong = scored.filter("flag OR sentiment = 'NEGATIVE' OR size(pii) > 0 OR pending OR lang = 'de'")
    plan = strong._jdf.queryExecution().executedPlan().toString()
    for piece in ("split(", "RLIKE", "regexp_extract_all("):
        assert plan.count(piece) == plain.count(piece)
    assert 0 < strong.count() < d.count() + 1


def test_stream_emits_notices_without_job_once_no_job_can_come(spark, tmp_path):
    def deliver(name, jobs, notices):
        schema = "job_id STRING, t STRING"
        for kind, rows, column in (("jobs", jobs, "submitted_at"), ("notices", notices, "sent_at")):
            df = spark.createDataFrame(rows, schema).select("job_id", F.to_timestamp("t").alias(column))
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / kind))

    def run():
        left = spark.readStream.schema("job_id STRING, submitted_at TIMESTAMP").parquet(str(tmp_path / "jobs"))
        right = spark.readStream.schema("job_id STRING, sent_at TIMESTAMP").parquet(str(tmp_path / "notices"))
        out = m.stream_match_jobs(left, right, watermark="1 hour", max_wait="6 hours", how="right_outer")
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
            availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return {(r["job_id"], r["submitted_at"] is not None) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    deliver("one", [("a", "2024-01-01 00:00:00")], [("a", "2024-01-01 01:00:00"), ("lost", "2024-01-01 01:00:00")])
    assert run() == {("a", True)}
    deliver("two", [("z", "2024-02-01 00:00:00")], [("z", "2024-02-01 01:00:00")])
    assert run() == {("a", True), ("lost", False), ("z", True)}


def test_large_lexicons_as_frames_give_the_same_types_and_rows(spark, sf):
    from modspark import defaults

    d = m.with_tokens(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang"))
    policy = spark.createDataFrame(defaults.POLICY_PHRASES, "category_no INT, category STRING, phrase STRING, lang STRING")
    lexicon = spark.createDataFrame(defaults.TOXICITY_LEXICON, "class STRING, word STRING, lang STRING")
    results = []
    for limits in ({}, {"inline_limit": 0}, {"inline_limit": 0, "trie_limit": 0}):
        out = m.toxicity(m.policy_verdict(d, policy, **limits), lexicon, **limits)
        results.append((out.select("doc_id", "flag", "category", "reason", "toxicity").orderBy("doc_id").collect(), dict(out.dtypes)))
    assert results[0] == results[1] == results[2]


def test_stream_puts_under_the_query_id(spark, tmp_path):
    write_events(tmp_path / "in", "a.json", event("in/a.txt", "1"))
    query = m.stream_moderation(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ckpt"))
    query.awaitTermination()
    assert [p.name for p in (tmp_path / "store").glob("writer=*")] == [f"writer={query.id}"]


def test_size_check_counts_rows_and_bytes(spark):
    from modspark.operators.joins import is_small

    flat = spark.createDataFrame([("a" * 100, 1), (None, None), ("é", 2)], "word STRING, n INT")
    assert is_small(flat, 3, 150) and not is_small(flat, 2, 150) and not is_small(flat, 3, 100)
    nested = flat.select(F.array("word").alias("w"), F.struct("n").alias("s"), F.lit(None).alias("x"))
    assert is_small(nested, 3, 400) and not is_small(nested, 3, 100)
    assert is_small(flat.limit(0), 0, 0)
    seen = []
    real = F.to_json
    try:
        F.to_json = lambda *a, **k: seen.append(a) or real(*a, **k)
        is_small(flat)
        assert not seen
        is_small(nested)
        assert len(seen) == 2
    finally:
        F.to_json = real
