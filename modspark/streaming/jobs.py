"""Submitted jobs joined with their completion notices as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_match_jobs(
    jobs: DataFrame,
    notices: DataFrame,
    *,
    job_time: str = "submitted_at",
    notice_time: str = "sent_at",
    watermark: str = "1 hour",
    max_wait: str = "6 hours",
    how: str = "inner",
    salts: int = 8,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Notice ↔ job by id, the notice at most ``max_wait`` after the job.

    Both sides are watermarked and bounded in time, so the state drops a job once no notice of it
    can still arrive.  ``how='right_outer'`` also emits notices that never found their job, once the
    watermark has passed them.

    A job may have very many notices: their state is cut into ``salts`` parts by a hash of
    ``spread_by`` (by default the notice's time), and every part holds the job.  Unmatched
    jobs cannot be told from parts, so ``left_outer`` and ``full_outer`` need ``salts=1``.
    """
    if salts > 1 and how not in ("inner", "right_outer"):
        raise ValueError(f"{how} needs salts=1")
    part = F.pmod(F.xxhash64(*(spread_by or [notice_time])), F.lit(salts)).cast("int")
    parts = F.explode(F.array(*[F.lit(i) for i in range(salts)]))
    left = jobs.withWatermark(job_time, watermark).withColumn("_part", parts).alias("j")
    right = notices.withWatermark(notice_time, watermark).withColumn("_part", part).alias("n")
    same = (
        (F.col("j.job_id") == F.col("n.job_id"))
        & (F.col("j._part") == F.col("n._part"))
        & (F.col(f"n.{notice_time}") >= F.col(f"j.{job_time}"))
        & (F.col(f"n.{notice_time}") <= F.col(f"j.{job_time}") + F.expr(f"interval {max_wait}"))
    )
    keep_left = [F.col(f"j.{c}") for c in jobs.columns if c != "job_id"]
    keep_right = [F.col(f"n.{c}") for c in notices.columns]
    return left.join(right, same, how).select(*keep_right, *keep_left)
