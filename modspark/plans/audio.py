"""Audio plan over transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.operators.select import first_segment, full_transcript
from modspark.plans.text import moderate_text, text_result


def moderate_audio(
    transcripts: DataFrame, *, key: str = "job_name", whole: bool = True, **text_options
) -> DataFrame:
    """One row per recording: toxicity segments and text checks on the spoken text.

    ``whole=False`` checks the first segment only.
    """
    spoken = (full_transcript if whole else first_segment)(transcripts, name="spoken")
    scored = moderate_text(spoken, "spoken", id_col=key, **text_options)
    return scored.select(
        key,
        F.col("segments").alias("toxicity"),
        "spoken",
        F.when(F.length("spoken") > 0, text_result(None)).alias("text_checks"),
    )
