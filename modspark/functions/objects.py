"""Column functions over object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modspark.fixed_values import RESULTS_FOLDER


def uri(bucket: Column, key: Column, scheme: str = "s3") -> Column:
    return F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), key)


def extension(key: Column) -> Column:
    """Text after the last dot; a key without dot is returned whole, case is kept."""
    return F.element_at(F.split(key, r"\."), -1)


def result_key(key: Column) -> Column:
    parts = F.split(key, "/")
    return F.concat(
        F.element_at(parts, 1), F.lit(f"/{RESULTS_FOLDER}/"), F.element_at(parts, -1), F.lit(".json")
    )


def transcript_key(key: Column, suffix_length: int = 7) -> Column:
    """Text before the first dot plus a suffix that is a hash of the key, so reruns agree."""
    suffix = F.substring(F.sha2(key, 256), 1, suffix_length)
    return F.concat(F.element_at(F.split(key, r"\."), 1), suffix, F.lit(".json"))


def object_key(file_uri: Column) -> Column:
    """The key part of ``scheme://bucket/key``."""
    return F.regexp_extract(file_uri, r"^[^:]+://[^/]*/(.*)$", 1)
