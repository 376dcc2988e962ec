"""Object events to one nested result per object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.operators.routing import MODALITIES, with_extension, with_modalities, with_uri
from modspark.plans.text import moderate_text, text_result
from modspark.sources.results import latest_per_key


def routed_objects(
    events: DataFrame, *, scheme: str = "s3", ignore_case: bool = False, rules=MODALITIES
) -> DataFrame:
    """The newest event per supported object with its modalities."""
    located = with_modalities(
        with_extension(with_uri(events, scheme=scheme)), ignore_case=ignore_case, rules=rules
    )
    # Reduced inside the tasks first: many events of one object cost one row per task.
    supported = located.filter(F.size("modalities") > 0).select(
        "file_uri", "key", "sequencer", "event_time", "modalities"
    )
    return latest_per_key(supported, "file_uri", ["sequencer", "event_time"])


def moderate_objects(
    events: DataFrame,
    *,
    images: DataFrame | None = None,
    recordings: DataFrame | None = None,
    texts: DataFrame | None = None,
    scheme: str = "s3",
    ignore_case: bool = False,
    **text_options,
) -> DataFrame:
    """One row per routed object: file_uri, Image_moderation, Audio_moderation, Text_moderation.

    ``images`` is the output of ``moderate_image`` and ``recordings`` that of ``moderate_audio``
    (with its key named file_uri), both keyed by object; ``texts`` has (file_uri, text) and, with
    ``lang=...``, a language column.  A side that is not given leaves its column out.  Each side is
    unique per object, so the joins share one hash partitioning by file_uri and no key is hot.
    Texts are scored after the join: only those of routed objects, in place.
    """
    result = routed_objects(events, scheme=scheme, ignore_case=ignore_case)
    for name, modality, side in (
        ("Image_moderation", "image", images),
        ("Audio_moderation", "audio", recordings),
        ("_text", "text", texts),
    ):
        if side is None:
            continue
        nested = side.select(
            "file_uri", F.struct(*[c for c in side.columns if c != "file_uri"]).alias("_side")
        )
        result = (
            result.join(nested, "file_uri", "left")
            .withColumn(name, F.when(F.array_contains("modalities", modality), F.col("_side")))
            .drop("_side")
        )
    return result if texts is None else _with_text_result(result, text_options)


def _with_text_result(result: DataFrame, options: dict) -> DataFrame:
    keep = [c for c in result.columns if c != "_text"]
    flat = result.select("file_uri", F.struct(*keep).alias("_kept"), "_text.*")
    scored = moderate_text(flat, "text", id_col="file_uri", **options)
    return scored.select("_kept.*", text_result("text").alias("Text_moderation"))
