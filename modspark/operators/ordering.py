"""Running positions inside a key without sending one key to one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modspark.scratch import settle

# A block of blocks, so that the last running sum sees one row per this many blocks.
BLOCKS_PER_GROUP = 1024


def running_position(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[Column],
    name: str,
    weight: Column | None = None,
    levels: int = 2,
) -> DataFrame:
    """Add how many rows (or how much ``weight``) precede each row within ``keys``.

    ``block`` is a number that does not decrease along ``order``.  Rows without a key belong together,
    and rows without a block come last in their key.  Rows are
    numbered inside (keys, block), so a key that holds a third of all rows is still spread over its
    blocks.  What precedes a block is found the same way from one row per block, ``levels`` times;
    only the last, tiny sum runs over a whole key.
    """
    weight = F.lit(1) if weight is None else weight
    blocked = df.withColumns({"_block": block.cast("bigint"), "_weight": weight.cast("bigint")})
    by_block = [*keys, "_block"]
    counts = blocked.groupBy(*by_block).agg(F.sum("_weight").alias("_in_block"))
    if levels > 1:
        earlier = running_position(
            counts.withColumnRenamed("_block", "_b").withColumnRenamed("_in_block", "_n"),
            keys,
            F.floor(F.col("_b") / BLOCKS_PER_GROUP),
            [F.col("_b").asc_nulls_last()],
            "_earlier",
            F.col("_n"),
            levels - 1,
        ).select(*keys, F.col("_b").alias("_block"), F.col("_earlier").alias("_before"))
    else:
        so_far = F.sum("_in_block").over(
            Window.partitionBy(*keys).orderBy(F.col("_block").asc_nulls_last())
        )
        earlier = counts.select(*by_block, (so_far - F.col("_in_block")).alias("_before"))
    inside = Window.partitionBy(*by_block).orderBy(*order)
    numbered = blocked.withColumn(
        "_inside",
        F.sum("_weight").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_weight"),
    )
    other = earlier.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(by_block)], "_before")
    same = reduce(and_, [numbered[c].eqNullSafe(other[f"_of_{i}"]) for i, c in enumerate(by_block)])
    return (
        numbered.join(other, same)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_block", "_weight", "_before", "_inside", *[f"_of_{i}" for i in range(len(by_block))])
    )


def range_placed(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows in ranges of (keys, order), kept as a table, with ``_part`` and the place ``_at`` in it.

    Rows that are equal in all of these are told apart by where they came from, so even a key whose
    rows all have one time is spread evenly over the ranges.
    """
    own = df.withColumn("_own", F.monotonically_increasing_id())
    by = [*map(F.col, keys), *order, F.col("_own")]
    placed = own.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    # The number of a partition and the place in it, as Spark packs them.
    return settle(placed.withColumns({
        "_part": F.shiftright("_at", 33).cast("int"), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)),
    }).drop("_own"))


def ranked_position(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add how many rows precede each row within ``keys``, whatever ties the order has.

    Rows are sorted in ranges; a row's place is its place in the range plus the rows of its key in
    earlier ranges.  Only one row for each key and range is summed over a key.  Rows without a key
    belong together.
    """
    placed = range_placed(df, keys, order)
    parts = placed.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    names = [*keys, "_part"]
    shifts = parts.withColumn("_before", F.coalesce(earlier, F.lit(0))).select(
        *[F.col(c).alias(f"_of_{i}") for i, c in enumerate(names)], (F.col("_before") - F.col("_first")).alias("_shift")
    )
    # A key's rows of one range: never more than a range holds.
    same = reduce(and_, [placed[c].eqNullSafe(shifts[f"_of_{i}"]) for i, c in enumerate(names)])
    return placed.join(shifts, same).withColumn(name, (F.col("_at") + F.col("_shift")).cast("bigint")).drop(
        "_at", "_part", "_shift", *[f"_of_{i}" for i in range(len(names))]
    )
