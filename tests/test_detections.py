import json

import pytest
from pyspark.sql import functions as F

import modspark as m
from modspark import schemas
from modspark.operators.ordering import running_position


def doc(spark, kind, body):
    df = spark.createDataFrame([("img/1", json.dumps(body)), ("img/2", "not json"), ("img/3", "{}")], "file_uri STRING, payload STRING")
    return m.parse_detections(df, "payload", kind)


TEXTS = {"TextDetections": [
    {"DetectedText": "K512 ABC", "Type": "LINE", "Id": 0, "Confidence": 99.2},
    {"DetectedText": "K512", "Type": "WORD", "Id": 1, "ParentId": 0, "Confidence": 98.9},
    {"DetectedText": "call 16500000222", "Type": "LINE", "Id": 2, "Confidence": 60.0},
    {"DetectedText": "K512", "Type": "WORD", "Id": 3, "ParentId": 0, "Confidence": 99.0}], "Other": 1}


def test_every_kind_has_a_schema_and_parses_broken_documents(spark):
    for kind in schemas.DETECTIONS:
        assert doc(spark, kind, {}).count() == 3
    with pytest.raises(ValueError):
        doc(spark, "nothing", {})


def test_moderation_labels(spark):
    d = doc(spark, "moderation", {"ModerationLabels": [
        {"Confidence": 99.9, "Name": "Swimwear", "ParentName": "Suggestive"},
        {"Confidence": 90.5, "Name": "Suggestive", "ParentName": ""}], "ResponseMetadata": {"x": 1}})
    got = m.moderation_labels(d).collect()
    assert [(r["name"], r["parent"], r["is_top_level"]) for r in got] == [
        ("Swimwear", "Suggestive", False), ("Suggestive", "", True)]


def test_text_found_in_images(spark):
    d = doc(spark, "image_text", TEXTS)
    assert [r["confident_text"] for r in m.confident_text(d).orderBy("file_uri").collect()] == ["K512 ABCK512", "", ""]
    assert m.confident_text(d, lines_only=True).orderBy("file_uri").head()["confident_text"] == "K512 ABC"
    assert [r["lines"] for r in m.line_list(d).orderBy("file_uri").collect()] == [["K512 ABC", "call 16500000222"], [], []]
    assert [(r["id"], r["parent_id"]) for r in m.image_text(d).collect()] == [(0, None), (1, 0), (2, None), (3, 0)]
    assert [(r["line_no"], r["pii_type"]) for r in m.line_pii(d).collect()] == [(1, "PHONE")]


def test_faces_and_age(spark):
    def face(low, **more):
        return {"AgeRange": {"Low": low, "High": low + 8}, "Gender": {"Value": "Female", "Confidence": 99.0},
                "Smile": {"Value": True, "Confidence": 80.0}, "Emotions": [
                    {"Type": "CALM", "Confidence": 10.0}, {"Type": "HAPPY", "Confidence": 70.0}], **more}

    d = doc(spark, "faces", {"FaceDetails": [face(30), face(20, Confidence=99.5)]})
    rows = m.faces(d).orderBy("face_no").collect()
    assert [(r["age_low"], r["gender"], r["smile"], r["top_emotion"]) for r in rows] == [
        (30, "Female", True, "HAPPY"), (20, "Female", True, "HAPPY")]
    ages = {r["file_uri"]: (r["age"], r["age_min"], r["age_max"]) for r in m.image_age(d).collect()}
    assert ages == {"img/1": (20, 20, 38), "img/2": (None,) * 3, "img/3": (None,) * 3}


def test_celebrities_keep_unknown_faces(spark):
    d = doc(spark, "celebrities", {
        "CelebrityFaces": [{"Name": "A. Star", "Id": "1", "Urls": ["u"], "MatchConfidence": 99.0, "KnownGender": {"Type": "Female"}}],
        "UnrecognizedFaces": [{"Confidence": 97.0}]})
    got = m.celebrities(d).orderBy("recognized").collect()
    assert [(r["recognized"], r["name"], r["urls"]) for r in got] == [(False, None, None), (True, "A. Star", ["u"])]
    assert got[0]["face"]["Confidence"] == 97.0


def test_pii_and_languages_kinds(spark):
    d = doc(spark, "pii", {"Entities": [{"Score": 0.9, "Type": "NAME", "BeginOffset": 28, "EndOffset": 33}]})
    assert [tuple(r) for r in m.pii_rows(d, ["file_uri"]).collect()] == [("img/1", "NAME", 28, 33, 0.9)]
    s = doc(spark, "sentiment", {"Sentiment": "NEGATIVE", "SentimentScore": {"Negative": 0.9}})
    flags = {r["file_uri"]: r["sentiment_negative"] for r in m.negative_flag(s, "Sentiment", "SentimentScore").collect()}
    assert flags == {"img/1": True, "img/2": False, "img/3": False}


def test_transcripts(spark, tmp_path):
    body = {"jobName": "j", "status": "COMPLETED", "results": {
        "transcripts": [{"transcript": "Hi there."}],
        "items": [{"type": "pronunciation", "alternatives": [{"confidence": "0.99", "content": "Hi"}], "start_time": "0.0", "end_time": "0.4"},
                  {"type": "punctuation", "alternatives": [{"confidence": "0.0", "content": "."}]}],
        "toxicity_detection": [
            {"start_time": 0.0, "end_time": 4.2, "text": "Hi", "toxicity": 0.27, "categories": {"insult": 0.1, "sexual": 0.3}},
            {"start_time": 4.2, "end_time": 6.0, "text": "there.", "toxicity": 0.1, "categories": {}}]}}
    (tmp_path / "a.json").write_text(json.dumps(body, indent=2))
    t = m.read_transcripts(spark, str(tmp_path))
    assert m.first_segment(t).head()["text"] == "Hi"
    assert m.full_transcript(t).head()["text"] == "Hi there."
    assert {(r["segment"], r["category"], r["score"]) for r in m.toxicity_segments(t).collect()} == {
        (0, "insult", 0.1), (0, "sexual", 0.3)}
    result = m.moderate_audio(t).head()
    assert result["spoken"] == "Hi there." and result["text_checks"]["verdict"]["flag"] is False
    assert m.moderate_audio(t, whole=False).head()["spoken"] == "Hi"


def page(spark, rows):
    return m.parse_video_pages(spark.createDataFrame(rows, "job_id STRING, page_no INT, payload STRING"))


def test_pages_of_any_length_keep_their_order(spark):
    def labels(*names, codec="h264"):
        return json.dumps({"VideoMetadata": {"Codec": codec, "DurationMillis": 5}, "Labels": [
            {"Timestamp": i, "Label": {"Name": n, "Confidence": 1.0}} for i, n in enumerate(names)]})

    p = page(spark, [("a", 0, labels("x", "y")), ("a", 1, labels()), ("a", 2, labels("z", codec="other")), ("b", 0, labels("q"))])
    for block in (1, 2, 1000):
        rows = m.assemble_pages(p, "job_id", "page_no", "Labels", pages_per_block=block).collect()
        assert sorted((r["job_id"], r["position"], r["detection"]["Label"]["Name"]) for r in rows) == [
            ("a", 0, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 0, "q")]
    assert m.video_labels(p).count() == 4 and "position" in m.video_labels(p, numbered=True).columns
    meta = {r["job_id"]: r["codec"] for r in m.video_metadata(p).collect()}
    assert meta == {"a": "h264", "b": "h264"}


def test_persons_without_match_stay(spark):
    p = page(spark, [("a", 0, json.dumps({"Persons": [
        {"Timestamp": 1, "Person": {"Index": 0}, "FaceMatches": [{"Similarity": 99.0, "Face": {"FaceId": "f"}}]},
        {"Timestamp": 2, "Person": {"Index": 1}}, {"Timestamp": 3, "Person": {"Index": 2}, "FaceMatches": []}]}))])
    got = m.video_face_matches(p).orderBy("ts").collect()
    assert [(r["person"], r["face_id"]) for r in got] == [(0, "f"), (1, None), (2, None)]


def test_video_dispatch(spark):
    p = page(spark, [("a", 0, json.dumps({
        "Labels": [{"Timestamp": 1, "Label": {"Name": "x", "Confidence": 1.0}}],
        "Celebrities": [{"Timestamp": 2, "Celebrity": {"Name": "A. Star"}}],
        "Faces": [{"Timestamp": 3, "Face": {"Confidence": 9.0, "AgeRange": {"Low": 3}}}],
        "ModerationLabels": [{"Timestamp": 4, "ModerationLabel": {"Name": "v", "Confidence": 2.0, "ParentName": "w"}}],
        "Persons": [{"Timestamp": 5, "Person": {"Index": 7}}]}))])
    kinds = ["labels", "faces", "face_matches", "persons", "celebrities", "moderation"]
    got = {r["kind"]: r for r in m.moderate_video(p, kinds).collect()}
    assert set(got) == set(kinds)
    assert got["moderation"]["parent"] == "w" and got["faces"]["face"]["AgeRange"]["Low"] == 3
    with pytest.raises(ValueError):
        m.moderate_video(p, "sounds")


@pytest.mark.parametrize("width,levels", [(1, 1), (7, 2), (10_000, 2), (3, 3)])
def test_running_position_equals_counting(spark, width, levels):
    # Two thirds of the rows belong to one key.
    rows = [("hot" if i % 3 else f"k{i % 5}", (i * 7919) % 1000, i, i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "k STRING, ts BIGINT, id BIGINT, w BIGINT")
    out = running_position(df, ["k"], F.floor(F.col("ts") / width), [F.col("ts"), F.col("id")], "p", levels=levels)
    weighted = running_position(df, ["k"], F.floor(F.col("ts") / width), [F.col("ts"), F.col("id")], "p", F.col("w"), levels)
    for frame, size in ((out, lambda r: 1), (weighted, lambda r: r[3])):
        want, seen = {}, {}
        for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
            want[r[2]] = seen.get(r[0], 0)
            seen[r[0]] = want[r[2]] + size(r)
        assert {r["id"]: r["p"] for r in frame.collect()} == want


def test_result_pages_put_together_are_the_timeline(spark):
    df = spark.createDataFrame([("j", i * 1000, f"n{i % 3}", i) for i in range(25)], "job_id STRING, ts BIGINT, name STRING, id INT")
    whole = [r["id"] for r in m.timeline(df).collect()]
    parts = [
        [r["id"] for r in m.result_page(df, 10, k, block_ms=4000).orderBy("position").collect()] for k in range(3)]
    assert [len(p) for p in parts] == [10, 10, 5] and sum(parts, []) == whole


def test_all_video_analyses_in_one_parse(spark):
    from modspark.plans.video import ANALYSES

    page = """{"Labels": [{"Timestamp": 1, "Label": {"Name": "Dog", "Confidence": 90.0}}], "Persons": [
      {"Timestamp": 2, "Person": {"Index": 7}, "FaceMatches": [{"Similarity": 99.0, "Face": {"FaceId": "f"}}]},
      {"Timestamp": 3, "Person": {"Index": 8}}]}"""
    raw = spark.createDataFrame([("a", 0, page), ("a", 1, page), ("b", 0, "{}"), ("c", 0, "broken"), ("d", 0, None)],
                                "job_id STRING, page_no INT, payload STRING")
    parsed = m.parse_video_pages(raw, columns=m.page_columns(list(ANALYSES)))
    rows = m.moderate_video(parsed, list(ANALYSES), numbered=True)
    got = sorted((r["kind"], r["position"], r["page_no"], r["name"], r["person"], r["face_id"]) for r in rows.collect())
    assert got == sorted(
        [("labels", p, p, "Dog", None, None) for p in (0, 1)]
        + [("persons", 2 * p + i, p, None, 7 + i, None) for p in (0, 1) for i in (0, 1)]
        + [("face_matches", 2 * p + i, p, None, 7 + i, "f" if i == 0 else None) for p in (0, 1) for i in (0, 1)])
    plain = m.moderate_video(parsed, list(ANALYSES))
    assert plain._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert m.moderate_video(parsed, "persons").columns == ["job_id", "page_no", "item", "ts", "person", "kind"]
    with pytest.raises(ValueError):
        m.moderate_video(parsed, "sounds")


def test_positions_at_one_time_are_spread(spark):
    from modspark.operators.ordering import range_placed, ranked_position

    # Of so few bytes Spark would make one range.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(40_000).select(F.lit("a").alias("job_id"), F.lit(5).alias("ts"), F.lit("x").alias("name"), "id")
    sizes = sorted(r["n"] for r in range_placed(rows, ["job_id"], [F.col("ts"), F.col("name")]).groupBy("_part").agg(
        F.count("*").alias("n")).collect())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 3 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    got = ranked_position(rows, ["job_id"], [F.col("ts"), F.col("name")], "position")
    assert got.agg(F.count("*"), F.countDistinct("position"), F.min("position"), F.max("position")).head() == (40_000, 40_000, 0, 39_999)


def test_positions_equal_a_window(spark):
    from pyspark.sql import Window

    from modspark.operators.ordering import ranked_position

    rows = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("j"), F.least(F.col("id") % 5, F.lit(2)))).alias("job_id"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 40).alias("ts"), "id",
        F.create_map(F.lit("k"), F.col("id")).alias("extra"),
    ).repartition(5)
    window = Window.partitionBy("job_id").orderBy("ts", "id")
    want = {r["id"]: r["p"] for r in rows.select("id", (F.row_number().over(window) - 1).alias("p")).collect()}
    got = ranked_position(rows, ["job_id"], [F.col("ts"), F.col("id")], "p")
    assert got.columns == [*rows.columns, "p"] and {r["id"]: r["p"] for r in got.collect()} == want
    assert ranked_position(rows.limit(0), ["job_id"], [F.col("ts")], "p").count() == 0


def test_records_of_supplied_replies(spark):
    from decimal import Decimal

    reply = {
        "language_reply": '{"Languages": [{"LanguageCode": "fr", "Score": 0.9}, {"LanguageCode": "en", "Score": 0.1}]}',
        "sentiment_reply": '{"Sentiment": "NEGATIVE", "SentimentScore": {"Negative": 0.123456789012345}}',
        "pii_reply": '{"Entities": [{"Type": "NAME", "Score": 0.1, "BeginOffset": 1, "EndOffset": 2}, {"Type": "AGE", "Score": 1.0}]}',
        "toxic_reply": '{"ResultList": [{"Labels": [{"Name": "INSULT", "Score": 0.3}, {"Name": "INSULT", "Score": 0.7}], "Toxicity": 0.2},'
                       ' {"Labels": [], "Toxicity": 0.9}]}',
        "class_reply": '{"Classes": [{"Name": "SAFE", "Score": 0.6}, {"Name": "UNSAFE", "Score": 0.4}]}',
    }
    calm = {"pii_reply": '{"Entities": []}', "sentiment_reply": '{"Sentiment": "POSITIVE", "SentimentScore": {"Negative": 0.2}}'}
    schema = "doc_id INT, " + ", ".join(f"{c} STRING" for c in reply)
    df = spark.createDataFrame(
        [(1, *reply.values()), (2, *[{**reply, **calm}[c] for c in reply]), (3, "x", None, "{}", "[", "")], schema)
    record = m.analyze_replies(df)
    one, two, three = record.orderBy("doc_id").collect()
    assert (one["lang"], one["sentiment_negative"], one["pii_type"], one["prompt_class"]) == ("fr", True, "NAME", "SAFE")
    assert (one["negative_score"], one["pii_score"], one["toxicity"]) == (Decimal("0.123456789012345"), Decimal("0.1"), Decimal("0.2"))
    assert one["toxicity_labels"] == {"INSULT": Decimal("0.7")} and one["prompt_score"] == Decimal("0.6") and one["missing"] == []
    assert (two["sentiment_negative"], two["negative_score"], two["pii_type"], two["missing"]) == (False, 0, None, [])
    assert three["missing"] == ["languages", "sentiment", "pii", "toxic_text", "classes"] and three["negative_score"] is None
    assert record._jdf.queryExecution().executedPlan().toString().count("from_json") == 5
    assert m.analyze_replies(df, replies={"classes": "class_reply"}).columns == ["doc_id", "prompt_class", "prompt_score", "missing"]
    with pytest.raises(ValueError):
        m.analyze_replies(df, replies={"smell": "x"})
