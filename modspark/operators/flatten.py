"""Detector outputs to rows.  All of it is narrow: explode and struct fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.operators.rows import explode_rows
from modspark.schemas import FACE_FLAGS
from modspark.sources.detections import assemble_pages


def moderation_labels(df: DataFrame, uri: str = "file_uri", labels: str = "ModerationLabels") -> DataFrame:
    return explode_rows(df, [uri], labels, "l").select(
        uri,
        F.col("l.Name").alias("name"),
        F.col("l.ParentName").alias("parent"),
        F.col("l.Confidence").alias("confidence"),
        (F.coalesce(F.col("l.ParentName"), F.lit("")) == "").alias("is_top_level"),
    )


def _top_emotion(emotions: Column) -> Column:
    return F.array_max(
        F.transform(
            emotions,
            lambda e: F.struct(e["Confidence"].alias("confidence"), e["Type"].alias("type")),
        )
    )


def face_columns(face: Column) -> list[Column]:
    flags = [
        c
        for name in FACE_FLAGS
        for c in (
            face[name]["Value"].alias(name.lower()),
            face[name]["Confidence"].alias(f"{name.lower()}_confidence"),
        )
    ]
    top = _top_emotion(face["Emotions"])
    return [
        face["BoundingBox"].alias("box"),
        face["AgeRange"]["Low"].alias("age_low"),
        face["AgeRange"]["High"].alias("age_high"),
        face["Gender"]["Value"].alias("gender"),
        face["Gender"]["Confidence"].alias("gender_confidence"),
        *flags,
        face["Pose"].alias("pose"),
        face["Quality"].alias("quality"),
        top["type"].alias("top_emotion"),
        top["confidence"].alias("top_emotion_confidence"),
        face["Confidence"].alias("confidence"),
    ]


def faces(df: DataFrame, uri: str = "file_uri", col: str = "FaceDetails") -> DataFrame:
    """One row per face, numbered in document order."""
    return explode_rows(df, [uri], col, "f", "face_no").select(
        uri, "face_no", *face_columns(F.col("f"))
    )


def celebrities(df: DataFrame, uri: str = "file_uri") -> DataFrame:
    """Recognised and unrecognised faces in one frame, told apart by ``recognized``."""
    # One pass: both arrays are brought to one shape and concatenated before the explode.
    known = F.transform(
        F.coalesce(F.col("CelebrityFaces"), F.array()),
        lambda c: F.struct(
            F.lit(True).alias("recognized"),
            c["Name"].alias("name"),
            c["Id"].alias("celebrity_id"),
            c["MatchConfidence"].alias("match_confidence"),
            c["KnownGender"]["Type"].alias("gender"),
            c["Urls"].alias("urls"),
            c["Face"].alias("face"),
        ),
    )
    nothing = F.lit(None)
    unknown = F.transform(
        F.coalesce(F.col("UnrecognizedFaces"), F.array()),
        lambda f: F.struct(
            F.lit(False).alias("recognized"),
            nothing.cast("string").alias("name"),
            nothing.cast("string").alias("celebrity_id"),
            nothing.cast("double").alias("match_confidence"),
            nothing.cast("string").alias("gender"),
            nothing.cast("array<string>").alias("urls"),
            f.alias("face"),
        ),
    )
    return explode_rows(df, [uri], F.concat(known, unknown), "c").select(uri, "c.*")


def image_text(df: DataFrame, uri: str = "file_uri", col: str = "TextDetections") -> DataFrame:
    return explode_rows(df, [uri], col, "t").select(
        uri,
        F.col("t.Id").alias("id"),
        F.col("t.ParentId").alias("parent_id"),
        F.col("t.Type").alias("type"),
        F.col("t.DetectedText").alias("text"),
        F.col("t.Confidence").alias("confidence"),
        F.col("t.Geometry.BoundingBox").alias("box"),
    )


def pii_rows(df: DataFrame, ids: Sequence[str], col: str = "Entities") -> DataFrame:
    """Entities array (detector shape) to rows."""
    return explode_rows(df, ids, col, "e").select(
        *ids,
        F.col("e.Type").alias("type"),
        F.col("e.BeginOffset").alias("begin"),
        F.col("e.EndOffset").alias("end"),
        F.col("e.Score").alias("score"),
    )


def toxicity_segments(df: DataFrame, id_col: str = "job_name", col: str = "segments") -> DataFrame:
    """Transcript segments by category."""
    return explode_rows(df, [id_col], col, "s", "segment").select(
        id_col, "segment", "s.start", "s.end", "s.text", "s.toxicity",
        F.explode("s.categories").alias("category", "score"),
    )


# --- video result pages -------------------------------------------------------------------------


def _timed(pages: DataFrame, items: str, numbered: bool) -> DataFrame:
    slim = pages.select("job_id", "page_no", items)
    rows = assemble_pages(slim, "job_id", "page_no", items, numbered=numbered)
    place = ["position"] if numbered else []
    return rows.select("job_id", "page_no", "item", *place,
                       F.col("detection.Timestamp").alias("ts"), "detection")


def video_labels(pages: DataFrame, numbered: bool = False) -> DataFrame:
    return _timed(pages, "Labels", numbered).withColumns(
        {"name": F.col("detection.Label.Name"), "confidence": F.col("detection.Label.Confidence")}
    ).drop("detection")


def video_persons(pages: DataFrame, numbered: bool = False) -> DataFrame:
    return _timed(pages, "Persons", numbered).withColumn(
        "person", F.col("detection.Person.Index")
    ).drop("detection")


def video_moderation(pages: DataFrame, numbered: bool = False) -> DataFrame:
    label = F.col("detection.ModerationLabel")
    return _timed(pages, "ModerationLabels", numbered).withColumns(
        {"name": label["Name"], "parent": label["ParentName"], "confidence": label["Confidence"]}
    ).drop("detection")


def video_faces(pages: DataFrame, numbered: bool = False) -> DataFrame:
    return _timed(pages, "Faces", numbered).withColumns(
        {"face": F.col("detection.Face"), "confidence": F.col("detection.Face.Confidence")}
    ).drop("detection")


def video_face_matches(pages: DataFrame, numbered: bool = False) -> DataFrame:
    """Persons with their matched faces; a person without match keeps one row."""
    rows = _timed(pages, "Persons", numbered)
    keep = [c for c in rows.columns if c != "detection"]
    return rows.select(
        *keep,
        F.col("detection.Person.Index").alias("person"),
        F.explode_outer("detection.FaceMatches").alias("m"),
    ).select(
        *keep, "person", F.col("m.Face.FaceId").alias("face_id"), F.col("m.Similarity").alias("similarity")
    )


def video_celebrities(pages: DataFrame, numbered: bool = False) -> DataFrame:
    return _timed(pages, "Celebrities", numbered).withColumn(
        "name", F.col("detection.Celebrity.Name")
    ).drop("detection")


def video_metadata(pages: DataFrame) -> DataFrame:
    """One row per job: the metadata of its first page, reduced before the shuffle."""
    first = F.min_by("VideoMetadata", "page_no")
    return (
        pages.filter(F.col("VideoMetadata").isNotNull())
        .groupBy("job_id")
        .agg(first.alias("m"))
        .select(
            "job_id",
            F.col("m.Codec").alias("codec"),
            F.col("m.DurationMillis").alias("duration_ms"),
            F.col("m.Format").alias("format"),
            F.col("m.FrameRate").alias("frame_rate"),
        )
    )
