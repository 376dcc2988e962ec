"""Size checks before broadcasting, and joins that survive one dominant key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType, VariantType

# A lookup of at most this many rows is written into the plan as literals or broadcast.
INLINE_LIMIT = 4096
BROADCAST_LIMIT = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Hashes of keys that are sent to every task (32 MB).
KEY_HASHES = 4_000_000


def rows_or_frame(
    source: DataFrame | Iterable[Sequence], columns: Sequence[str], limit: int = INLINE_LIMIT
) -> tuple[list[tuple] | None, DataFrame | None]:
    """``(rows, None)`` when the lookup has at most ``limit`` rows, else ``(None, frame)``.

    At most ``limit + 1`` rows ever reach the driver.
    """
    if isinstance(source, DataFrame):
        frame = source.select(*columns).distinct()
        head = frame.limit(limit + 1).collect()
        return ([tuple(r) for r in head], None) if len(head) <= limit else (None, frame)
    rows = [tuple(r) for r in source]
    if len(rows) <= limit:
        return rows, None
    return None, SparkSession.active().createDataFrame(rows, list(columns)).distinct()


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``limit`` rows of together at most ``max_bytes``.

    Sizes are counted inside the tasks and only the sums travel; no rows meet in one task.  Strings count
    with their bytes and plain values with 8, so nothing but nested columns is printed to be measured.
    """
    size = sum((_bytes(df, f) for f in df.schema.fields), F.lit(0))
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).head()
    return n <= limit and total <= max_bytes


def _bytes(df: DataFrame, field: StructField) -> Column:
    value = df[f"`{field.name}`"]
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0))
    return F.lit(8)


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    on: str,
    spread_by: Sequence[str],
    how: str = "left",
    salts: int = 16,
    limit: int = BROADCAST_LIMIT,
    small: bool | None = None,
) -> DataFrame:
    """Join a large frame with a lookup that has one row per key.

    A lookup that passes the size check is broadcast.  A larger one is joined by shuffle: a key may
    hold a third of ``many``, so every key is cut into ``salts`` parts by a hash of ``spread_by``
    and the lookup is repeated once per part.  Parts that are still too large are ordinary skewed
    partitions, which adaptive execution splits further.
    """
    if small is None:
        small = is_small(one, limit)
    if small:
        return many.join(F.broadcast(one), on, how)
    return salted_join(many, one, on, spread_by, how, salts)


def salted_join(
    many: DataFrame, one: DataFrame, on: str, spread_by: Sequence[str], how: str, salts: int = 16
) -> DataFrame:
    part = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted = many.withColumn("_salt", part)
    repeated = one.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    # Spark takes the repeated rows to be as many as before and would broadcast them all.
    return salted.join(repeated.hint("merge"), [on, "_salt"], how).drop("_salt")


def sized_join(many: DataFrame, one: DataFrame, on: str, how: str = "inner", small: bool | None = None) -> DataFrame:
    """Join with a lookup that is broadcast only if it passes the size check, and else sorted like ``many``.

    For keys that are never hot.  Left to itself Spark goes by the bytes of compressed files, of which a
    broadcast takes ten times as much memory on the driver.
    """
    if small is None:
        small = is_small(one)
    return many.join(F.broadcast(one) if small else one.hint("merge"), on, how)


def may_match(many: DataFrame, one: DataFrame, on: Sequence[str], besides: Column, limit: int = KEY_HASHES) -> DataFrame:
    """The rows of ``many`` whose key may be in ``one``, and those with ``besides``: what a join that counts only
    these has to move.  ``on`` has the same types on both sides.

    Keys are known by 64-bit hashes, so a few others may pass and none is lost; ``one`` with more than
    ``limit`` keys keeps all rows.  ``one`` is read here and should be a table.
    """
    key = F.xxhash64(*on)
    hashes = one.select(key.alias("h")).distinct()
    if hashes.count() > limit:
        return many
    known = np.sort(np.asarray(hashes.toArrow().column("h"), dtype=np.int64))
    shared = one.sparkSession.sparkContext.broadcast(known)
    names, schema = many.columns, many.schema

    def passing(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known, bits = shared.value, np.zeros(1 << 24, dtype=bool)
        bits[known & (len(bits) - 1)] = True
        for batch in batches:
            own = np.asarray(batch.column("_key"))
            passes = bits[own & (len(bits) - 1)]
            at = np.flatnonzero(passes)
            if len(at):
                place = np.minimum(np.searchsorted(known, own[at]), len(known) - 1)
                passes[at] = known[place] == own[at]
            passes |= batch.column("_keep").fill_null(False).to_numpy(zero_copy_only=False)
            yield batch.select(names).filter(pa.array(passes))

    return many.select("*", key.alias("_key"), besides.alias("_keep")).mapInArrow(passing, schema)


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
