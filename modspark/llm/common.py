"""Words, row order and intermediate tables shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modspark.operators.rows import compute_once
from modspark.scratch import freed_shuffles
from modspark.scratch import settle as _settle

__all__ = ["BLANKS", "WORD_GAP", "compute_once", "freed_shuffles", "keyed", "ordered_rows", "settle",
           "table", "words"]

BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for an empty or missing text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def settle(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Keep a frame as a table in the shared folder and read it back; ``parts`` bounds the number of
    files of one that is known to be small."""
    return _settle(df if parts is None else df.coalesce(parts))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_row, _id, _text, _all)``: every row with a long that is its own and keeps the order of ids.

    Ids that are unique and present are used as they are; the check moves ids only.  Otherwise rows
    are numbered in the order (id with missing first, text), each repeated row on its own, and kept
    in a table so that the numbers stay.  Missing texts are empty in ``_text``; ``_all`` is the row.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_all"),
    )
    counts = rows.groupBy("_id").agg(F.count("*").alias("n"))
    if not counts.filter((F.col("n") > 1) | F.col("_id").isNull()).limit(1).count():
        return rows.select(F.col("_id").alias("_row"), "_id", "_text", "_all")
    # Sorted ranges: the partition's number in the high bits, the place in it in the low ones.
    order = [F.col("_id").asc_nulls_first(), F.col("_text").asc()]
    return settle(rows.orderBy(*order).select(F.monotonically_increasing_id().alias("_row"), "_id", "_text", "_all"))


def ordered_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_row, _id, _text)`` of ``keyed``."""
    return keyed(docs.select(id_col, text_col), id_col, text_col).select("_row", "_id", "_text")


def ranked(values: DataFrame, by: str) -> DataFrame:
    """Add ``_rank``, 0 for the smallest ``by``; the rows need not fit one task.

    Sorted partitions are numbered inside and shifted by the sizes of those before them; only the
    sizes of partitions, at most one for each shuffle partition, meet in one place.
    """
    parts = settle(values.orderBy(by).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(by)) - 1
    shifts = sizes.select("_part", before.alias("_before"))
    return (
        parts.withColumn("_place", place).join(F.broadcast(shifts), "_part")
        .withColumn("_rank", (F.col("_place") + F.col("_before")).cast("long"))
        .drop("_part", "_place", "_before")
    )
