"""Result documents and the keyed store that keeps the latest record per key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.operators.joins import is_small
from modspark.sources import buckets as B

MODALITY_COLUMNS = {
    "Image_moderation": "image",
    "Audio_moderation": "audio",
    "Text_moderation": "text",
}

#: When a record was put, in microseconds; part of the store, not of what is read back.
PUT_TIME = "_put_at"


def result_documents(df: DataFrame, modalities: dict[str, str] = MODALITY_COLUMNS) -> DataFrame:
    """Objects with at least one modality result, plus ``modality`` (joined by ``+``)."""
    present = [
        F.when(F.col(c).isNotNull(), F.lit(name)) for c, name in modalities.items() if c in df.columns
    ]
    return df.withColumn("modality", F.concat_ws("+", *present)).filter(F.col("modality") != "")


def write_results(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per object under ``modality=.../``; objects without result are skipped."""
    result_documents(df).write.mode(mode).partitionBy("modality").json(path)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The whole newest record of every key.

    This is an aggregation, not a window: each task keeps one record per key before the shuffle,
    so a key that holds a third of the rows sends one record per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order_by))
    # The key columns stay as grouped, so that a later join on them needs no further shuffle.
    return df.groupBy(*keys).agg(newest.alias("_row")).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def upsert_latest(
    df: DataFrame,
    store: str,
    key: str | Sequence[str],
    order_by: Sequence[str],
    *,
    writer: str | None = None,
    batch_id: int = 0,
) -> str:
    """Put records into a keyed store; a new record replaces the old one whole.  Returns the writer.

    A put writes only its own rows, as ``writer=W/batch_id=N/``, and readers merge.  Without
    ``writer`` every put is a writer of its own, so puts never touch each other's rows.  The same
    writer writing the same batch again replaces that batch, so a replayed stream batch changes
    nothing.  A store that does not exist yet is created.  ``order_by`` decides between records of
    one key; at equal values the later put wins.
    """
    writer = writer or uuid.uuid4().hex
    rows = latest_per_key(df, key, list(order_by)).withColumn(PUT_TIME, F.unix_micros(F.current_timestamp()))
    rows.write.mode("overwrite").parquet(f"{store}/writer={writer}/batch_id={batch_id}")
    return writer


def read_latest(
    spark: SparkSession, store: str, key: str | Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The current record per key; at equal ``order_by`` the later put wins.

    Of a store that :func:`compact_buckets` has compacted only live files are opened.  Its records are
    passed through without any shuffle, but for the keys of puts that came since; those meet their
    earlier records in the buckets they belong to.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [*order_by, PUT_TIME, "writer", "batch_id"]
    known = B.manifest(spark, store)
    if known is None:
        puts = spark.read.option("mergeSchema", "true").parquet(store).withColumn(
            "writer", F.col("writer").cast("string")
        )
        return latest_per_key(puts, keys, order).drop(PUT_TIME, "writer", "batch_id")
    fresh = [p for put, p in B.put_folders(spark, store).items() if put not in known.puts]
    base = B.read_base(spark, store, known)
    hidden = [PUT_TIME, "writer", "batch_id", "bucket"]
    if not fresh:
        return base.drop(*hidden)
    delta = latest_per_key(B.read_puts(spark, store, fresh), keys, order)
    if base is None:
        return delta.drop(*hidden)
    changed = delta.select(*keys).withColumn("bucket", B.bucket_of(keys, known.buckets))
    touched = [r[0] for r in changed.select("bucket").distinct().collect()]  # at most one for each bucket
    affected = B.read_base(spark, store, known, touched)
    if affected is None:
        return base.unionByName(delta, allowMissingColumns=True).drop(*hidden)
    if is_small(changed):
        changed = F.broadcast(changed.drop("bucket"))
    else:
        changed = changed.drop("bucket")
    earlier = affected.join(changed, keys, "left_semi").drop("bucket")
    merged = latest_per_key(earlier.unionByName(delta, allowMissingColumns=True), keys, order)
    same = base.join(changed, keys, "left_anti")
    return same.unionByName(merged, allowMissingColumns=True).drop(*hidden)


def compact_buckets(
    spark: SparkSession, store: str, key: str | Sequence[str], order_by: Sequence[str], buckets: int = B.BUCKETS
) -> list[int]:
    """Merge the puts since the last compaction into the buckets they touch; returns those.

    Buckets without new records keep their files, puts stay as they are.  The number of buckets is
    fixed by the first compaction; choose it so that a bucket's current records fit a task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = B.manifest(spark, store)
    buckets = known.buckets if known else buckets
    puts = B.put_folders(spark, store)
    fresh = [p for put, p in puts.items() if known is None or put not in known.puts]
    if not fresh:
        return []
    order = [*order_by, PUT_TIME, "writer", "batch_id"]
    delta = latest_per_key(B.read_puts(spark, store, fresh), keys, order)
    number = B.bucket_of(keys, buckets)
    touched = sorted(r[0] for r in delta.select(number).distinct().collect())  # at most one for each bucket
    earlier = B.read_base(spark, store, known, touched) if known else None
    rows = delta if earlier is None else earlier.drop("bucket").unionByName(delta, allowMissingColumns=True)
    B.write_version(spark, store, latest_per_key(rows, keys, order).withColumn("bucket", number), touched, known, buckets, list(puts))
    return touched


def compact_store(
    spark: SparkSession, store: str, target: str, key: str | Sequence[str], order_by: Sequence[str]
) -> None:
    """Write the merged store as the first put of a new store; the old one is left alone.

    Puts into the new store come later and so win at equal ``order_by``.
    """
    upsert_latest(read_latest(spark, store, key, order_by), target, key, order_by, writer="compacted")
