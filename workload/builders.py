"""Detector-shaped inputs derived from the test tables, as Spark jobs.

The JSON documents go through the readers and parsers of the package; the checking SQL computes
its rows from the tables directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import fixed_values as V
from modspark.operators.joins import salted_join
from modspark.operators.select import with_result_page
from workload.tables import load

BUCKET = "review-bucket"
EXTENSIONS = ["jpg", "png", "mp4", "mov", "mp3", "txt", "JPG", "bin"]


def _cycle(values: list[str], by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))


def media_manifest(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages")
    return pages.select(
        "page_id",
        F.lit(BUCKET).alias("bucket"),
        F.concat(F.lit("in/"), F.col("page_id").cast("string"), F.lit("."),
                 _cycle(EXTENSIONS, F.col("page_id"))).alias("key"),
        F.length("html").cast("bigint").alias("size"),
        "url",
        "html",
    )


def object_event_json(spark: SparkSession, sf: str) -> DataFrame:
    """Pages 2k and 2k+1 share one event document, whose ``Records`` is parsed again later."""
    m = media_manifest(spark, sf)
    record = F.struct(
        F.concat(
            F.expr("timestampadd(MINUTE, page_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").cast("string"),
            F.lit("Z"),
        ).alias("eventTime"),
        F.lit("ObjectCreated:Put").alias("eventName"),
        F.struct(
            F.struct(F.col("bucket").alias("name")).alias("bucket"),
            F.struct(
                "key", "size", F.md5(F.col("key")).alias("eTag"),
                F.lpad(F.col("page_id").cast("string"), 6, "0").alias("sequencer"),
            ).alias("object"),
        ).alias("s3"),
    )
    return (
        m.select(F.floor(F.col("page_id") / 2).alias("k"), record.alias("r"))
        .groupBy("k")
        .agg(F.collect_list("r").alias("Records"))
        .select(F.to_json(F.struct("Records")).alias("value"))
    )


def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Events as timed detections: job, ms since the job's first event, name, confidence."""
    e = load(spark, sf, "events").select(
        "event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "event_type", "value"
    )
    first = e.groupBy("user_id").agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))
    return salted_join(e, first, "user_id", ["event_id"], "inner").select(
        F.col("user_id").cast("string").alias("job_id"),
        "event_id",
        (F.col("ms") - F.col("first_ms")).alias("ts"),
        (F.col("last_ms") - F.col("first_ms")).alias("duration"),
        F.col("event_type").alias("name"),
        F.least(F.col("value") / 5, F.lit(100.0)).alias("confidence"),
        F.when(F.col("event_type") == "error", "").otherwise("activity").alias("parent"),
        F.col("value").alias("value"),
    )


def video_pages(spark: SparkSession, sf: str, items: dict[str, Column]) -> DataFrame:
    """Result pages (job_id, page_no, payload) with ten detections per page in time order."""
    timed = with_result_page(event_times(spark, sf), V.RESULT_PAGE_SIZE, tie=("event_id",))
    metadata = F.struct(
        F.lit("h264").alias("Codec"), F.max("duration").alias("DurationMillis"),
        F.lit("QuickTime / MOV").alias("Format"), F.lit(29.97).alias("FrameRate"),
    )
    # A page holds ten detections, so its list is bounded.
    lists = [
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", item.alias("d")))), lambda x: x["d"]
        ).alias(name)
        for name, item in items.items()
    ]
    return (
        timed.groupBy("job_id", "page_no")
        .agg(metadata.alias("VideoMetadata"), *lists)
        .select("job_id", "page_no", F.to_json(F.struct("VideoMetadata", *items)).alias("payload"))
    )


def label_item() -> Column:
    return F.struct(
        F.col("ts").alias("Timestamp"),
        F.struct(F.col("name").alias("Name"), F.col("confidence").alias("Confidence")).alias("Label"),
    )


def moderation_item() -> Column:
    return F.struct(
        F.col("ts").alias("Timestamp"),
        F.struct(
            F.col("name").alias("Name"), F.col("confidence").alias("Confidence"),
            F.col("parent").alias("ParentName"),
        ).alias("ModerationLabel"),
    )


def face_item() -> Column:
    """A face whose age bounds and confidence come from the event."""
    low = F.floor("confidence").cast("int")
    return F.struct(
        F.col("ts").alias("Timestamp"),
        F.struct(
            F.struct(low.alias("Low"), (low + 8).alias("High")).alias("AgeRange"),
            F.col("confidence").alias("Confidence"),
        ).alias("Face"),
    )


def person_item() -> Column:
    """Persons; a purchase matches two faces of the collection, a view matches one, others none."""
    def match(suffix: str, similarity: Column) -> Column:
        return F.struct(
            similarity.alias("Similarity"),
            F.struct(F.concat("name", F.lit(suffix)).alias("FaceId")).alias("Face"),
        )

    one, two = match("-a", F.col("confidence")), match("-b", F.col("confidence") / 2)
    return F.struct(
        F.col("ts").alias("Timestamp"),
        F.struct((F.col("event_id") % 7).alias("Index")).alias("Person"),
        F.when(F.col("name") == "purchase", F.array(one, two))
        .when(F.col("name") == "view", F.array(one)).alias("FaceMatches"),
    )


def celebrity_item() -> Column:
    return F.struct(
        F.col("ts").alias("Timestamp"),
        F.struct(F.concat(F.lit("Celebrity "), F.col("name")).alias("Name")).alias("Celebrity"),
    )


def image_uri(number: Column) -> Column:
    return F.concat(F.lit("img/"), number.cast("string"))


def moderation_json(spark: SparkSession, sf: str) -> DataFrame:
    """Moderation documents: ten neighbouring events are the labels of an image."""
    e = load(spark, sf, "events")
    label = F.struct(
        F.least(F.col("value") / 5, F.lit(100.0)).alias("Confidence"),
        F.col("event_type").alias("Name"),
        F.when(F.col("event_type") == "error", "").otherwise("activity").alias("ParentName"),
    )
    return (
        e.select(image_uri(F.floor(F.col("event_id") / 10)).alias("file_uri"), "event_id", label.alias("l"))
        .groupBy("file_uri")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "l"))),
                         lambda x: x["l"]).alias("ModerationLabels"))
        .select("file_uri", F.to_json(F.struct("ModerationLabels", F.lit("6.1").alias("ModerationModelVersion")))
                .alias("payload"))
    )


def faces_json(spark: SparkSession, sf: str) -> DataFrame:
    """Face documents: ten neighbouring vectors share an image."""
    v = load(spark, sf, "embeddings")
    uri = image_uri(F.floor(F.col("vec_id") / 10))
    x = F.transform("embedding", lambda f: f.cast("double"))
    low = F.col("label") * 5
    face = F.struct(
        F.struct(x[0].alias("Width"), x[1].alias("Height"), x[2].alias("Left"), x[3].alias("Top")).alias("BoundingBox"),
        F.struct(low.alias("Low"), (low + 8).alias("High")).alias("AgeRange"),
        F.struct((x[4] > 0).alias("Value"), F.abs(x[4]).alias("Confidence")).alias("Smile"),
        F.struct(F.when(x[5] > 0, "Female").otherwise("Male").alias("Value"),
                 F.abs(x[5]).alias("Confidence")).alias("Gender"),
        F.array(
            F.struct(F.lit("CALM").alias("Type"), x[6].alias("Confidence")),
            F.struct(F.lit("HAPPY").alias("Type"), x[7].alias("Confidence")),
            F.struct(F.lit("SAD").alias("Type"), x[8].alias("Confidence")),
        ).alias("Emotions"),
        F.struct(x[9].alias("Roll"), x[10].alias("Yaw"), x[11].alias("Pitch")).alias("Pose"),
        F.abs(x[12]).alias("Confidence"),
    )
    return (
        v.select(uri.alias("file_uri"), "vec_id", face.alias("f"))
        .groupBy("file_uri")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "f"))), lambda s: s["f"]).alias("FaceDetails"))
        .select("file_uri", F.to_json(F.struct("FaceDetails")).alias("payload"))
    )


def celebrities_json(spark: SparkSession, sf: str) -> DataFrame:
    """One document per customer: recognised when the balance is positive, else an unknown face."""
    c = load(spark, sf, "customer")
    known = F.when(
        F.col("c_acctbal") >= 0,
        F.array(
            F.struct(
                F.array(F.concat(F.lit("www.example.org/"), "c_name"), F.col("c_mktsegment")).alias("Urls"),
                F.col("c_name").alias("Name"),
                F.col("c_custkey").cast("string").alias("Id"),
                (F.col("c_acctbal") / 100).alias("MatchConfidence"),
                F.struct(F.when(F.col("c_nationkey") > 12, "Female").otherwise("Male").alias("Type")).alias("KnownGender"),
            )
        ),
    ).otherwise(F.array())
    unknown = F.when(
        F.col("c_acctbal") < 0,
        F.array(F.struct((-F.col("c_acctbal") / 100).alias("Confidence"))),
    ).otherwise(F.array())
    return c.select(
        image_uri(F.col("c_custkey")).alias("file_uri"),
        F.to_json(F.struct(known.alias("CelebrityFaces"), unknown.alias("UnrecognizedFaces"))).alias("payload"),
    )


# Heading and paragraph texts of a page, tags removed.
BLOCK = r"(?s)<(?:h1|p)>(.*?)</(?:h1|p)>"
TAG = r"<[^>]*>"


def image_text_column(html: Column) -> Column:
    """Detections: LINE per heading or paragraph, then its words as WORD, numbered from 0."""
    lines = F.transform(
        F.regexp_extract_all(html, F.lit(BLOCK), F.lit(1)), lambda b: F.regexp_replace(b, TAG, "")
    )
    flat = F.flatten(
        F.transform(
            lines,
            lambda line, i: F.concat(
                F.array(F.struct(line.alias("text"), F.lit("LINE").alias("type"), i.alias("line"))),
                F.transform(
                    F.filter(F.split(line, " "), lambda w: w != ""),
                    lambda w: F.struct(w.alias("text"), F.lit("WORD").alias("type"), i.alias("line")),
                ),
            ),
        )
    )
    return F.transform(
        flat,
        lambda d, i: F.struct(
            d["text"].alias("DetectedText"),
            d["type"].alias("Type"),
            i.alias("Id"),
            F.when(d["type"] == "WORD", d["line"]).alias("ParentId"),
            (F.lit(95.0) + F.pmod(i, F.lit(6))).alias("Confidence"),
        ),
    )


def image_text_json(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages", spread="page_id")
    return pages.select(
        "page_id",
        image_uri(F.col("page_id")).alias("file_uri"),
        F.to_json(F.struct(image_text_column(F.col("html")).alias("TextDetections"))).alias("payload"),
    )


TURNS_PER_RECORDING = 1000


def transcript_json(spark: SparkSession, sf: str) -> DataFrame:
    """A segment per turn.  A recording holds at most a thousand turns, so its list is bounded
    and a conversation of any length becomes several recordings."""
    c = load(spark, sf, "conversations")
    n = F.length("text")
    segment = F.struct(
        (F.col("turn") * 5.0).alias("start_time"),
        (F.col("turn") * 5.0 + 4.0).alias("end_time"),
        "text",
        (n / (n + 100.0)).alias("toxicity"),
        F.struct(
            (n / (n + 200.0)).alias("profanity"),
            F.when(F.col("role") == "user", 0.5).otherwise(0.25).alias("insult"),
        ).alias("categories"),
    )
    part = F.floor(F.col("turn") / TURNS_PER_RECORDING)
    return (
        c.select(F.concat_ws("-", F.lit("conv"), "conv_id", part).alias("jobName"), "turn", segment.alias("s"))
        .groupBy("jobName")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "s"))), lambda x: x["s"])
             .alias("toxicity_detection"))
        .select(
            F.to_json(
                F.struct("jobName", F.lit(V.JOB_COMPLETED).alias("status"),
                         F.struct("toxicity_detection").alias("results"))
            ).alias("payload"),
        )
    )


def job_notice_json(spark: SparkSession, sf: str) -> DataFrame:
    """A notice per event: job = user and type; errors fail, views are still running."""
    e = load(spark, sf, "events")
    status = (
        F.when(F.col("event_type") == "error", V.JOB_FAILED)
        .when(F.col("event_type") == "view", "IN_PROGRESS")
        .otherwise(V.JOB_COMPLETED)
    )
    message = F.to_json(
        F.struct(F.concat_ws(":", "user_id", "event_type").alias("JobId"), status.alias("Status"))
    )
    return e.select("event_id", F.to_json(F.struct(message.alias("Message"))).alias("Body"))


def submitted_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs of which some event has a value of at least 100."""
    e = load(spark, sf, "events")
    return (
        e.filter(F.col("value") >= 100)
        .groupBy(F.concat_ws(":", "user_id", "event_type").alias("job_id"))
        .agg(F.min("event_id").alias("submitted_as"))
    )


def verdict_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Replies per label: JSON after a blank, prose for poor quality, and key:value lines."""
    l = load(spark, sf, "labels")
    flag = F.when(F.col("toxic") == 1, "yes").otherwise("false")
    doc = F.concat(
        F.lit(' {\n  "flag": "'), flag, F.lit('",\n  "category": "'),
        F.when(F.col("toxic") == 1, "Hate Symbols").otherwise(""),
        F.lit('",\n  "reason": "the reason\nis '), F.col("quality").cast("string"), F.lit('"\n}'),
    )
    prose = F.lit("I do not have enough context to decide.")
    lines = F.concat(
        F.lit(' Here is my assessment:\nResult:"'),
        F.when(F.col("toxic") == 1, V.RESULT_UNSAFE).otherwise(V.RESULT_SAFE),
        F.lit('"\nDegree of harm: "'),
        F.when(F.col("toxic") == 1, "High").otherwise("None"),
        F.lit('"\nExplanation\nratio: 1:2\nQuality: '), F.col("quality").cast("string"),
    )
    return l.select(
        "doc_id", "toxic", "quality",
        F.when((F.col("quality") == 0) & (F.col("toxic") == 0), prose).otherwise(doc).alias("json_reply"),
        lines.alias("line_reply"),
    )


def detector_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies of a hosted detector per document, with scores in thousandths that come from its length.

    Every tenth document has a toxicity reply that broke off; every third has no personal data.
    """
    d = load(spark, sf, "documents", spread="doc_id")
    n = F.length("text")

    def score(k: int) -> Column:
        return F.pmod(n * k, F.lit(1000)) / 1000

    labels = [F.struct(F.lit(c).alias("Name"), score(i).alias("Score")) for i, c in enumerate(V.TOXICITY_CATEGORIES, 2)]
    entities = F.array(
        F.struct(score(7).alias("Score"), F.when(n % 2 == 0, "EMAIL").otherwise("PHONE").alias("Type")),
        F.struct(F.lit(1.0).alias("Score"), F.lit("NAME").alias("Type")),
    )
    toxic = F.to_json(F.struct(F.array(
        F.struct(F.array(*labels).alias("Labels"), score(11).alias("Toxicity")),
        F.struct(F.array().cast("array<struct<Name:string,Score:double>>").alias("Labels"), F.lit(1.0).alias("Toxicity")),
    ).alias("ResultList")))
    return d.select(
        "doc_id",
        F.to_json(F.struct(F.array(
            F.struct(F.col("lang").alias("LanguageCode"), score(13).alias("Score")),
            F.struct(F.lit("xx").alias("LanguageCode"), F.lit(0.0).alias("Score")),
        ).alias("Languages"))).alias("language_reply"),
        F.to_json(F.struct(
            _cycle(["NEGATIVE", "POSITIVE", "NEUTRAL", "MIXED"], F.col("doc_id")).alias("Sentiment"),
            F.struct(score(17).alias("Negative"), score(19).alias("Positive")).alias("SentimentScore"),
        )).alias("sentiment_reply"),
        F.to_json(F.struct(
            F.when(F.col("doc_id") % 3 == 0, F.slice(entities, 1, 0)).otherwise(entities).alias("Entities")
        )).alias("pii_reply"),
        F.when(F.col("doc_id") % 10 == 7, F.substring(toxic, 1, 5)).otherwise(toxic).alias("toxic_reply"),
        F.to_json(F.struct(F.array(F.struct(
            F.when(n % 5 == 0, "UNSAFE_PROMPT").otherwise("SAFE_PROMPT").alias("Name"), score(23).alias("Score")
        )).alias("Classes"))).alias("class_reply"),
    )
