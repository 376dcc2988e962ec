"""Readers for detector documents, job notices and paged video results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modspark import schemas
from modspark.operators.ordering import running_position
from modspark.operators.rows import compute_once, explode_rows


def parse_detections(df: DataFrame, col: str, kind: str) -> DataFrame:
    """Replace a JSON column by the typed columns of one detector kind.

    Missing and unknown fields are fine; a broken document gives NULLs.  Only the fields that are
    used later are parsed.
    """
    if kind not in schemas.DETECTIONS:
        raise ValueError(f"unknown kind {kind!r}; use one of {sorted(schemas.DETECTIONS)}")
    keep = [c for c in df.columns if c != col]
    parsed = F.from_json(F.col(col), schemas.DETECTIONS[kind])
    return df.select(*keep, parsed.alias("_d")).select(*keep, "_d.*")


def parse_job_notices(df: DataFrame, body: str = "Body") -> DataFrame:
    """(job_id, status) out of a notice: JSON that holds its message as JSON text."""
    keep = [c for c in df.columns if c != body]
    message = F.from_json(F.col(body), schemas.NOTICE_BODY)["Message"]
    notice = F.from_json(message, schemas.NOTICE_MESSAGE)
    # A join by job id adds a not-null filter, which must not parse every notice again.
    return compute_once(df, _n=notice).select(
        *keep, F.col("_n.JobId").alias("job_id"), F.col("_n.Status").alias("status")
    )


def read_job_notices(
    spark: SparkSession, path: str, streaming: bool = False, extra_fields: str | None = None
) -> DataFrame:
    """Completion notices from JSON files; ``extra_fields`` adds outer columns, e.g. a send time."""
    reader = spark.readStream if streaming else spark.read
    ddl = "Body STRING" + (f", {extra_fields}" if extra_fields else "")
    return parse_job_notices(reader.schema(ddl).json(path))


def parse_video_pages(df: DataFrame, col: str = "payload", columns: Sequence[str] | None = None) -> DataFrame:
    """Replace a JSON result page by its typed columns.

    ``columns`` names those that are wanted: they are parsed together, once.  Without it every column
    that is used later is parsed on its own.
    """
    keep = [c for c in df.columns if c != col]
    if columns is None:
        page = F.from_json(F.col(col), schemas.VIDEO_PAGE)
        return df.select(*keep, page.alias("_p")).select(*keep, "_p.*")
    wanted = StructType([f for f in StructType.fromDDL(schemas.VIDEO_PAGE) if f.name in columns])
    return compute_once(df, _p=F.from_json(F.col(col), wanted)).select(*keep, "_p.*")


def assemble_pages(
    df: DataFrame,
    job_col: str,
    page_col: str,
    items_col: str,
    numbered: bool = True,
    pages_per_block: int = 1000,
) -> DataFrame:
    """One row per detection of paged results, with ``position`` in the job from 0.

    Pages may differ in length.  Positions come from running sums over page sizes in blocks of
    pages, so a job that holds most pages is spread too.  ``numbered=False`` skips the positions
    and with them every shuffle; (page, ``item``) is still an exact order.
    """
    if numbered:
        pages = running_position(
            df,
            [job_col],
            F.floor(F.col(page_col) / pages_per_block),
            [F.col(page_col)],
            "_start",
            F.greatest(F.size(items_col), F.lit(0)),
        )
    else:
        pages = df
    keep = [c for c in df.columns if c != items_col]
    extra = ["_start"] if numbered else []
    rows = explode_rows(pages, [*keep, *extra], items_col, "detection", "item")
    rows = rows.select(*keep, *extra, "item", "detection")
    if not numbered:
        return rows
    return rows.withColumn("position", F.col("_start") + F.col("item")).drop("_start")
