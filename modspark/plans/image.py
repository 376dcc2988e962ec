"""Image plans over parsed detector documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import defaults
from modspark import fixed_values as V
from modspark.functions import text as T
from modspark.operators.routing import review_decision
from modspark.operators.select import confident_text, image_age, line_list
from modspark.plans.text import moderate_text, text_result
from modspark.sources.detections import parse_detections

IMAGE_KINDS = ["moderation", "faces", "celebrities", "image_text"]


def gather_detections(
    df: DataFrame, uri: str = "file_uri", kind: str = "kind", payload: str = "payload",
    order_by: str | None = None,
) -> DataFrame:
    """(uri, kind, payload) rows to one row per image with one JSON column per kind.

    One shuffle for all four detectors instead of a join for each.  Of several documents of a kind
    the newest by ``order_by`` counts.  Picking among texts sorts them, and an image has about one document
    of a kind, so they are picked after the shuffle, in partitions of the size that it makes, and not
    before it, where the sort would hold all documents of an input split.
    """

    def pick(k: str) -> Column:
        if order_by is None:
            return F.max(F.when(F.col(kind) == k, F.col(payload)))
        return F.max_by(payload, F.when(F.col(kind) == k, F.col(order_by)))

    return df.repartition(F.col(uri)).groupBy(uri).agg(*[pick(k).alias(k) for k in IMAGE_KINDS])


def parse_image_documents(df: DataFrame) -> DataFrame:
    """Typed columns out of the four JSON columns named by ``IMAGE_KINDS``."""
    for kind in IMAGE_KINDS:
        df = parse_detections(df, kind, kind)
    return df


def moderate_image(
    dets: DataFrame,
    threshold: float = V.IMAGE_TEXT_MIN_CONFIDENCE,
    *,
    lines_only: bool = False,
    uri: str = "file_uri",
    **text_options,
) -> DataFrame:
    """One row per image: labels, faces, celebrities, detected text, and text checks on it.

    ``dets`` has the columns of :func:`parse_image_documents`.  The text checks are columns of the
    same row, NULL when no confident text was found, so the plan needs no join.
    """
    with_text = confident_text(dets, threshold, lines_only)
    scored = moderate_text(with_text, "confident_text", id_col=uri, **text_options)
    return scored.select(
        uri,
        F.col("ModerationLabels").alias("labels"),
        F.col("FaceDetails").alias("faces"),
        F.struct("CelebrityFaces", "UnrecognizedFaces").alias("celebrities"),
        F.col("confident_text"),
        F.col("TextDetections").alias("image_text"),
        F.when(F.length("confident_text") > 0, text_result(None)).alias("text_checks"),
    )


def image_record(
    dets: DataFrame,
    threshold: float = V.MODERATION_MIN_CONFIDENCE,
    *,
    uri: str = "file_uri",
    patterns: Iterable = tuple(defaults.PII_PATTERNS),
) -> DataFrame:
    """Keyed record per image: decision, labels at the floor, age, lines, first entity per line."""
    dets = dets.withColumn(
        "labels",
        F.transform(
            F.filter("ModerationLabels", lambda l: l["Confidence"] >= threshold),
            lambda l: F.struct(
                l["Name"].alias("name"),
                l["ParentName"].alias("parent"),
                T.exact(l["Confidence"]).alias("confidence"),
            ),
        ),
    )
    # A missing label array stays missing, so that it goes to review.
    decided = review_decision(dets, "ModerationLabels", threshold)
    lines = line_list(image_age(decided), name="lines")
    first_entity = f"get({T.pii_sql('line', list(patterns))}, 0)"
    entities = F.expr(f"filter(transform(lines, line -> {first_entity}), e -> e IS NOT NULL)")
    summary = F.transform(
        entities, lambda e: F.struct(e["type"].alias("type"), T.exact(e["score"]).alias("score"))
    )
    return lines.withColumn("line_entities", summary).select(
        uri, "decision", "labels", "age", "age_min", "age_max", "lines", "line_entities"
    )


