"""Projections, filters and routing of objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import fixed_values as V
from modspark.functions import objects, text as T

MODALITIES = [
    (ext, modality)
    for modality, extensions in [
        ("image", V.IMAGE_EXTENSIONS),
        ("video", V.VIDEO_EXTENSIONS),
        ("audio", V.AUDIO_EXTENSIONS),
        ("text", V.TEXT_EXTENSIONS),
    ]
    for ext in extensions
]


def modality_table(spark: SparkSession) -> DataFrame:
    """The (ext, modality) dimension as a table."""
    return spark.createDataFrame(MODALITIES, "ext STRING, modality STRING")


def with_uri(df: DataFrame, bucket: str = "bucket", key: str = "key", scheme: str = "s3") -> DataFrame:
    return df.withColumn("file_uri", objects.uri(F.col(bucket), F.col(key), scheme))


def with_extension(df: DataFrame, key: str = "key") -> DataFrame:
    return df.withColumn("ext", objects.extension(F.col(key)))


def _modalities(ext: str, ignore_case: bool, rules: Sequence[tuple[str, str]]):
    # The rule list is a fixed handful of rows, so it is a case expression, not a join.
    value = F.lower(F.col(ext)) if ignore_case else F.col(ext)
    order = list(dict.fromkeys(modality for _, modality in rules))
    return F.array_compact(
        F.array(
            *[
                F.when(value.isin([e for e, m in rules if m == modality]), F.lit(modality))
                for modality in order
            ]
        )
    )


def with_modalities(
    df: DataFrame,
    ext: str = "ext",
    ignore_case: bool = False,
    rules: Sequence[tuple[str, str]] = MODALITIES,
) -> DataFrame:
    """Add the array of modalities of an object, empty for an unknown extension."""
    return df.withColumn(
        "modalities",
        F.coalesce(_modalities(ext, ignore_case, rules), F.array().cast("array<string>")),
    )


def route_modalities(
    df: DataFrame,
    ext: str = "ext",
    ignore_case: bool = False,
    rules: Sequence[tuple[str, str]] = MODALITIES,
) -> DataFrame:
    """One row per object and modality; ``mp4`` gives two, an unknown extension none."""
    return df.withColumn("modality", F.explode(_modalities(ext, ignore_case, rules)))


def unsupported_objects(
    df: DataFrame,
    ext: str = "ext",
    ignore_case: bool = False,
    rules: Sequence[tuple[str, str]] = MODALITIES,
) -> DataFrame:
    """Objects that no modality takes; a missing extension counts as unsupported."""
    return df.filter(
        F.coalesce(F.size(_modalities(ext, ignore_case, rules)) == 0, F.lit(True))
    )


def with_result_key(df: DataFrame, key: str = "key") -> DataFrame:
    return df.withColumn("result_key", objects.result_key(F.col(key)))


def with_transcript_key(df: DataFrame, key: str = "key") -> DataFrame:
    return df.withColumn("transcript_key", objects.transcript_key(F.col(key)))


def needs_translation(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Texts that are not English, or of which the language is not known."""
    return df.filter(~F.col(lang).eqNullSafe("en"))


def min_confidence(
    df: DataFrame, threshold: float = V.MODERATION_MIN_CONFIDENCE, col: str = "confidence"
) -> DataFrame:
    return df.filter(F.col(col) >= threshold)


def only_lines(df: DataFrame, col: str = "type") -> DataFrame:
    return df.filter(F.col(col) == "LINE")


def has_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.filter(F.length(col) > 0)


def split_finished_jobs(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(completed, failed); jobs still running are in neither.  Both are pushed-down filters."""
    return df.filter(F.col(status) == V.JOB_COMPLETED), df.filter(F.col(status) == V.JOB_FAILED)


def review_decision(
    df: DataFrame, labels: str = "labels", threshold: float = V.MODERATION_MIN_CONFIDENCE
) -> DataFrame:
    """``Pass`` when no label reaches the floor, else ``Human review``; no label array means review."""
    strong = F.size(F.filter(F.col(labels), lambda x: x["Confidence"] >= threshold))
    decision = F.when(F.col(labels).isNotNull() & (strong == 0), V.DECISION_PASS).otherwise(
        V.DECISION_REVIEW
    )
    return df.withColumn("decision", decision)


def flag_decision(df: DataFrame, flag: str = "flag", name: str = "decision") -> DataFrame:
    """``Pass`` when the flag is false; a flagged text and one that could not be judged go to review."""
    passes = F.coalesce(~F.col(flag), F.lit(False))
    return df.withColumn(name, F.when(passes, V.DECISION_PASS).otherwise(V.DECISION_REVIEW))


def negative_flag(
    df: DataFrame, sentiment: str = "sentiment", scores: str = "sentiment_score"
) -> DataFrame:
    negative = F.coalesce(F.col(sentiment) == "NEGATIVE", F.lit(False))
    return df.withColumns(
        {
            "sentiment_negative": negative,
            "negative_score": F.when(negative, F.col(scores)["Negative"]).otherwise(F.lit(0.0)),
        }
    )


def exact_scores(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: T.exact(F.col(c)) for c in cols})
