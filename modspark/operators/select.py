"""Ordered picks, limits and text assembly."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import defaults
from modspark import fixed_values as V
from modspark.operators.ordering import ranked_position, running_position
from modspark.operators.rows import explode_rows
from modspark.operators.scoring import with_pii


def confident_text(
    df: DataFrame,
    threshold: float = V.IMAGE_TEXT_MIN_CONFIDENCE,
    lines_only: bool = False,
    col: str = "TextDetections",
    name: str = "confident_text",
) -> DataFrame:
    """Join confident detections of an image in document order, without separator.

    Lines and their words both count, so text can repeat; ``lines_only`` avoids that.
    """

    def keep(d: Column) -> Column:
        strong = d["Confidence"] >= threshold
        return strong & (d["Type"] == "LINE") if lines_only else strong

    texts = F.transform(F.filter(col, keep), lambda d: d["DetectedText"])
    return df.withColumn(name, F.coalesce(F.array_join(texts, ""), F.lit("")))


def line_list(df: DataFrame, col: str = "TextDetections", name: str = "lines") -> DataFrame:
    """Ordered texts of the LINE detections of an image."""
    lines = F.transform(F.filter(col, lambda d: d["Type"] == "LINE"), lambda d: d["DetectedText"])
    return df.withColumn(name, F.coalesce(lines, F.array().cast("array<string>")))


def top_language(
    df: DataFrame, min_score: float | None = None, col: str = "languages", name: str = "lang"
) -> DataFrame:
    """First of the language ranking; below an optional floor it is ``und``."""
    first = F.get(F.col(col), 0)
    code = first["lang"]
    if min_score is not None:
        code = F.when(first["score"] >= min_score, code).otherwise(F.lit("und"))
    return df.withColumn(name, code)


def first_pii(df: DataFrame, col: str = "pii") -> DataFrame:
    """Add type and score of the first entity of a text, NULL when there is none."""
    first = F.get(F.col(col), 0)
    return df.withColumns({"pii_type": first["type"], "pii_score": first["score"]})


def line_pii(
    df: DataFrame,
    ids: Sequence[str] = ("file_uri",),
    patterns: DataFrame | Iterable[tuple] = tuple(defaults.PII_PATTERNS),
    col: str = "TextDetections",
) -> DataFrame:
    """First entity of every line with one; lines are taken as they are, in any language."""
    lines = explode_rows(line_list(df.select(*ids, col), col, "_lines"), ids, "_lines", "line", "line_no")
    found = explode_rows(with_pii(lines, patterns, "line"), [*ids, "line_no", "line"], "pii", "_e", "_k")
    return found.filter(F.col("_k") == 0).select(
        *ids, "line_no", "line", F.col("_e.type").alias("pii_type"), F.col("_e.score").alias("pii_score")
    )


def image_age(df: DataFrame, col: str = "FaceDetails") -> DataFrame:
    """Add ``age`` (low bound of the last face) and the bounds over all faces; NULL without face."""
    return df.withColumns(
        {
            "age": F.try_element_at(F.col(col), F.lit(-1))["AgeRange"]["Low"],
            "age_min": F.array_min(F.transform(col, lambda f: f["AgeRange"]["Low"])),
            "age_max": F.array_max(F.transform(col, lambda f: f["AgeRange"]["High"])),
        }
    )


def timeline(df: DataFrame, job: str = "job_id", ts: str = "ts", tie: Sequence[str] = ("name",)) -> DataFrame:
    """Detections in time order per job.  A range sort: one job may span many partitions."""
    return df.orderBy(job, ts, *tie)


def with_result_page(
    df: DataFrame,
    n: int = V.RESULT_PAGE_SIZE,
    job: str = "job_id",
    ts: str = "ts",
    tie: Sequence[str] = ("name",),
    block_ms: int | None = None,
) -> DataFrame:
    """Add ``page_no`` (from 0) and ``position`` of each detection in its job's time order.

    Rows are numbered in sorted ranges, so neither a long job nor many detections at one time meet in a
    task.  With ``block_ms`` they are numbered per job and time block instead, which writes no table but
    needs times that are spread.
    """
    order = [F.col(ts), *map(F.col, tie)]
    if block_ms is None:
        placed = ranked_position(df, [job], order, "position")
    else:
        placed = running_position(df, [job], F.floor(F.col(ts) / block_ms), order, "position")
    return placed.withColumn("page_no", F.floor(F.col("position") / n))


def result_page(df: DataFrame, n: int = V.RESULT_PAGE_SIZE, page: int = 0, **order) -> DataFrame:
    """Page ``page`` of ``n`` ordered detections of every job."""
    return with_result_page(df, n, **order).filter(F.col("page_no") == page)


def first_segment(df: DataFrame, col: str = "segments", name: str = "text") -> DataFrame:
    return df.withColumn(name, F.get(F.col(col), 0)["text"])


def full_transcript(df: DataFrame, col: str = "segments", name: str = "text") -> DataFrame:
    """All segment texts in time order, joined by one blank."""
    ordered = F.array_sort(
        F.transform(col, lambda s, i: F.struct(s["start"].alias("start"), i.alias("i"), s["text"].alias("text")))
    )
    return df.withColumn(name, F.array_join(F.transform(ordered, lambda s: s["text"]), " "))
