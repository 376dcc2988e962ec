import modspark as m
from modspark.operators.routing import modality_table


def objects(spark, *keys):
    df = spark.createDataFrame([("box", k) for k in keys], "bucket STRING, key STRING")
    return m.with_extension(m.with_uri(df))


def test_uri_and_extension(spark):
    rows = {r["key"]: r for r in objects(spark, "a/b.c.JPG", "plain", "x.", "d.tar.gz").collect()}
    assert rows["a/b.c.JPG"]["file_uri"] == "s3://box/a/b.c.JPG"
    assert {k: r["ext"] for k, r in rows.items()} == {
        "a/b.c.JPG": "JPG", "plain": "plain", "x.": "", "d.tar.gz": "gz"}


def test_routing_covers_every_object_once(spark):
    df = objects(spark, "a.jpg", "a.jpeg", "a.png", "a.mp4", "a.mov", "a.mp3", "a.txt", "a.JPG", "a.bin", "none")
    routed = {(r["key"], r["modality"]) for r in m.route_modalities(df).collect()}
    assert ("a.mp4", "video") in routed and ("a.mp4", "audio") in routed
    assert ("a.mov", "video") in routed and ("a.mov", "audio") not in routed
    rest = {r["key"] for r in m.unsupported_objects(df).collect()}
    assert rest == {"a.JPG", "a.bin", "none"}
    assert {k for k, _ in routed} | rest == {r["key"] for r in df.collect()}
    assert {k for k, _ in routed} & rest == set()


def test_routing_can_ignore_case(spark):
    df = objects(spark, "a.JPG")
    assert [r["modality"] for r in m.route_modalities(df, ignore_case=True).collect()] == ["image"]
    assert m.unsupported_objects(df, ignore_case=True).count() == 0


def test_missing_extension_is_unsupported(spark):
    df = spark.createDataFrame([(None,)], "ext STRING")
    assert m.route_modalities(df).count() == 0
    assert m.unsupported_objects(df).count() == 1


def test_rules_agree_with_the_dimension_table(spark):
    table = modality_table(spark)
    joined = table.select("ext").distinct().join(table, "ext").collect()
    routed = m.route_modalities(table.select("ext").distinct()).collect()
    assert sorted(map(tuple, joined)) == sorted(map(tuple, routed))


def test_derived_keys(spark):
    df = spark.createDataFrame([("top/mid/pic.v2.jpg",)], "key STRING")
    row = m.with_transcript_key(m.with_result_key(df)).head()
    assert row["result_key"] == "top/content_moderation_results/pic.v2.jpg.json"
    assert row["transcript_key"].startswith("top/mid/pic") and row["transcript_key"].endswith(".json")
    assert row["transcript_key"] == m.with_transcript_key(df).head()["transcript_key"]


def test_review_decision(spark):
    t = "labels ARRAY<STRUCT<Confidence:DOUBLE, Name:STRING>>"
    df = spark.createDataFrame([(1, []), (2, [(59.9, "x")]), (3, [(60.0, "x")]), (4, None)], f"id INT, {t}")
    got = {r["id"]: r["decision"] for r in m.review_decision(df).collect()}
    assert got == {1: "Pass", 2: "Pass", 3: "Human review", 4: "Human review"}


def test_filters(spark):
    df = spark.createDataFrame([(1, 98.9, "LINE", ""), (2, 99.0, "WORD", "x")], "id INT, confidence DOUBLE, type STRING, text STRING")
    assert [r["id"] for r in m.min_confidence(df, 99.0).collect()] == [2]
    assert [r["id"] for r in m.only_lines(df).collect()] == [1]
    assert [r["id"] for r in m.has_text(df).collect()] == [2]


def test_finished_jobs(spark):
    df = spark.createDataFrame([("a", "COMPLETED"), ("b", "FAILED"), ("c", "IN_PROGRESS")], "job_id STRING, status STRING")
    done, failed = m.split_finished_jobs(df)
    assert [r["job_id"] for r in done.collect()] == ["a"]
    assert [r["job_id"] for r in failed.collect()] == ["b"]


def test_exact_scores_keep_the_shortest_text(spark):
    values = [5.258203600533307e-06, 99.9273910522461, 1.0]
    df = m.exact_scores(spark.createDataFrame([(v,) for v in values], "score DOUBLE"), ["score"])
    from decimal import Decimal

    assert [r["score"] for r in df.collect()] == [Decimal(str(v)) for v in values]


def test_unknown_language_needs_translation(spark):
    df = spark.createDataFrame([("en",), ("de",), (None,)], "lang STRING")
    assert sorted(str(r["lang"]) for r in m.needs_translation(df).collect()) == ["None", "de"]


def test_positions_keep_rows_without_job_or_block(spark):
    from pyspark.sql import functions as F

    from modspark.operators.ordering import running_position

    rows = [("a", 1), ("a", None), ("a", 3), (None, 1), (None, 5), (None, None)]
    df = spark.createDataFrame(rows, "job STRING, page INT")
    got = running_position(df, ["job"], F.col("page"), [F.col("page")], "at").collect()
    assert sorted((str(r["job"]), str(r["page"]), r["at"]) for r in got) == [
        ("None", "1", 0), ("None", "5", 1), ("None", "None", 2), ("a", "1", 0), ("a", "3", 1), ("a", "None", 2)]
    pages = df.select("job", "page", F.array(F.lit("x"), F.lit("y")).alias("items"))
    assert m.assemble_pages(pages, "job", "page", "items").count() == 12
