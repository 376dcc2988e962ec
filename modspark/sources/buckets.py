"""Compaction of the keyed store by key buckets.

Beside the puts (``writer=W/batch_id=N/``) a compacted store has ``_base/version=V/bucket=B/``, one
record per key, and ``_manifest/version=V/``, which tells for every bucket the version that is live and
which puts it holds.  A manifest counts once it is written whole; of two compactions at a time one
fails.  Nothing is ever changed in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE, MANIFEST = "_base", "_manifest"
BUCKETS = 64
_MANIFEST_TYPE = "buckets INT, live ARRAY<STRUCT<bucket:INT, version:INT>>, puts ARRAY<STRUCT<writer:STRING, batch_id:STRING>>"


class Manifest(NamedTuple):
    version: int
    buckets: int
    live: dict[int, int]
    puts: frozenset[tuple[str, str]]


def _folders(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    """Values and paths of the ``name=value`` folders of a folder, on any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return {}
    found = [s.getPath() for s in files.listStatus(at) if s.isDirectory()]
    return {p.getName().split("=", 1)[1]: f"{path}/{p.getName()}" for p in found if p.getName().startswith(f"{name}=")}


def _whole(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def put_folders(spark: SparkSession, store: str) -> dict[tuple[str, str], str]:
    """The puts that are written whole: (writer, batch id) → folder."""
    return {
        (writer, batch): path
        for writer, folder in _folders(spark, store, "writer").items()
        for batch, path in _folders(spark, folder, "batch_id").items() if _whole(spark, path)
    }


def manifest(spark: SparkSession, store: str) -> Manifest | None:
    versions = {int(v): p for v, p in _folders(spark, f"{store}/{MANIFEST}", "version").items() if _whole(spark, p)}
    if not versions:
        return None
    newest = max(versions)
    r = spark.read.schema(_MANIFEST_TYPE).json(versions[newest]).head()
    return Manifest(newest, r["buckets"], {x["bucket"]: x["version"] for x in r["live"]}, frozenset(map(tuple, r["puts"])))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_puts(spark: SparkSession, store: str, puts: Sequence[str]) -> DataFrame:
    read = spark.read.option("mergeSchema", "true").option("basePath", store).parquet(*puts)
    return read.withColumns({"writer": F.col("writer").cast("string"), "batch_id": F.col("batch_id").cast("string")})


def read_base(spark: SparkSession, store: str, known: Manifest, only: Sequence[int] | None = None) -> DataFrame | None:
    """The live files of all buckets, or of some."""
    root = f"{store}/{BASE}"
    paths = [f"{root}/version={v}/bucket={b}" for b, v in known.live.items() if only is None or b in set(only)]
    if not paths:
        return None
    return spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*paths).drop("version")


def write_version(
    spark: SparkSession, store: str, rows: DataFrame, touched: Sequence[int], known: Manifest | None, buckets: int,
    puts: Sequence[tuple[str, str]],
) -> None:
    """Write the touched buckets as a new version, then its manifest.

    Every bucket is dealt to a task of its own; a bucket is a hash of keys that are there once.
    """
    version = known.version + 1 if known else 0
    # Of a compaction that broke off before its manifest, the files are replaced.
    rows.repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
        f"{store}/{BASE}/version={version}")
    live = (known.live if known else {}) | dict.fromkeys(touched, version)
    row = (buckets, sorted(live.items()), [tuple(p) for p in sorted(puts)])
    spark.createDataFrame([row], _MANIFEST_TYPE).coalesce(1).write.mode("error").json(f"{store}/{MANIFEST}/version={version}")
