"""Video plan: any of six analyses over result pages, in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.operators.ordering import running_position
from modspark.operators.rows import explode_rows
from modspark.schemas import FACE


class _Analysis(NamedTuple):
    items: str
    columns: dict[str, Callable[[Column], Column]]


_TYPES = {
    "name": "string", "parent": "string", "confidence": "double", "person": "bigint", "face": FACE,
    "face_id": "string", "similarity": "double",
}


def _path(*fields: str) -> Callable[[Column], Column]:
    def of(item: Column) -> Column:
        for f in fields:
            item = item[f]
        return item

    return of


ANALYSES = {
    "labels": _Analysis("Labels", {"name": _path("Label", "Name"), "confidence": _path("Label", "Confidence")}),
    "faces": _Analysis("Faces", {"face": _path("Face"), "confidence": _path("Face", "Confidence")}),
    "face_matches": _Analysis("Persons", {
        "person": _path("Person", "Index"), "face_id": _path("match", "Face", "FaceId"), "similarity": _path("match", "Similarity"),
    }),
    "persons": _Analysis("Persons", {"person": _path("Person", "Index")}),
    "celebrities": _Analysis("Celebrities", {"name": _path("Celebrity", "Name")}),
    "moderation": _Analysis("ModerationLabels", {
        "name": _path("ModerationLabel", "Name"), "parent": _path("ModerationLabel", "ParentName"),
        "confidence": _path("ModerationLabel", "Confidence"),
    }),
}


def page_columns(kind: str | Sequence[str]) -> list[str]:
    """The columns of a parsed result page that the chosen analyses read."""
    return list(dict.fromkeys(ANALYSES[k].items for k in _kinds(kind)))


def _kinds(kind: str | Sequence[str]) -> list[str]:
    kinds = [kind] if isinstance(kind, str) else list(dict.fromkeys(kind))
    unknown = sorted(set(kinds) - set(ANALYSES))
    if unknown or not kinds:
        raise ValueError(f"unknown analyses {unknown}; use {sorted(ANALYSES)}")
    return kinds


def _items(kind: str, names: Sequence[str]) -> Column:
    """One analysis of a page as an array of rows of one shape for all analyses."""
    analysis = ANALYSES[kind]

    def row(item: Column, place: Column, of: Callable[[str], Column]) -> Column:
        return F.struct(
            place.cast("int").alias("item"), item["Timestamp"].alias("ts"),
            *[(of(n) if n in analysis.columns else F.lit(None)).cast(_TYPES[n]).alias(n) for n in names],
        )

    def plain(item: Column, place: Column) -> Column:
        return row(item, place, lambda n: analysis.columns[n](item))

    def matched(item: Column, place: Column) -> Column:
        """A row for each matched face; a person without match keeps one."""
        no_match = F.lit(None).cast("STRUCT<Similarity:DOUBLE, Face:STRUCT<FaceId:STRING>>")
        matches = F.when(F.size(item["FaceMatches"]) > 0, item["FaceMatches"]).otherwise(F.array(no_match))
        person = item["Person"]
        return F.transform(matches, lambda m: row(item, place, lambda n: analysis.columns[n]({"Person": person, "match": m})))

    if kind == "face_matches":
        return F.flatten(F.transform(analysis.items, matched))
    return F.transform(analysis.items, plain)


def moderate_video(
    pages: DataFrame, kind: str | Sequence[str] = "labels", numbered: bool = False, pages_per_block: int = 1000
) -> DataFrame:
    """Detections of the chosen analyses with their name in ``kind``; columns that only other analyses
    have are NULL.

    The pages are read once: every analysis becomes an array of rows of one shape, and all arrays of a
    page are exploded together.  ``numbered`` adds ``position``, the place in the job and analysis from
    0, by running sums over pages in blocks, so a long job is spread.
    """
    kinds = _kinds(kind)
    names = [n for n in _TYPES if any(n in ANALYSES[k].columns for k in kinds)]
    tagged = F.array(*[
        F.struct(F.lit(k).alias("kind"), _items(k, names).alias("rows"), F.greatest(F.size(ANALYSES[k].items), F.lit(0)).alias("n"))
        for k in kinds
    ])
    by_kind = explode_rows(pages, ["job_id", "page_no"], tagged, "a", "_k").select("job_id", "page_no", "a.*")
    place = []
    if numbered:
        place = ["position"]
        by_kind = running_position(
            by_kind, ["job_id", "kind"], F.floor(F.col("page_no") / pages_per_block), [F.col("page_no")], "_start", F.col("n")
        )
    keep = ["job_id", "page_no", "kind", *(["_start"] if numbered else [])]
    rows = explode_rows(by_kind, keep, "rows", "d").select(*keep, "d.*")
    if numbered:
        rows = rows.withColumn("position", F.col("_start") + F.col("item"))
    return rows.select("job_id", "page_no", "item", *place, "ts", *names, "kind")
