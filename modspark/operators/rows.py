"""Arrays to rows, and columns that are computed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.scratch import settle


def explode_rows(
    df: DataFrame, keep: Sequence[str | Column], array: str | Column, item: str, position: str = "_pos"
) -> DataFrame:
    """``keep`` plus one row per array element, with its place in ``position``.

    A plain explode lets the optimizer add a filter on the array's size.  Over a computed array,
    such as a parsed document, that filter computes the array a second time for every row; an outer
    explode with a test on the position gives the same rows and computes it once.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(position, item)).filter(
        F.col(position).isNotNull()
    )


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that no later step computes again.

    The optimizer moves a filter below the projection that computes its column by copying the
    expression into it; through a chain of projections such copies multiply.  A generated column
    cannot be copied, so a filter on a score costs one comparison.  Use it for what is costly and
    always wanted: generated columns are also not pruned.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(row)))


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Add a value that is each row's own, whatever ids the rows have, also repeated or missing ones.

    Rows that come straight from Parquet files are known by file and place in it: both sides of a later
    join see the same values, also after a lost executor, and nothing is written.  Where rows have
    been multiplied on the way (only their identity is read to see that), or come from elsewhere,
    they are numbered and kept as a table.
    """
    by_file = _with_file_place(df, name)
    if by_file is not None and not by_file.groupBy(name).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        return by_file
    return settle(df.withColumn(name, F.monotonically_increasing_id()))


def _with_file_place(df: DataFrame, name: str) -> DataFrame | None:
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return df.withColumn(name, place)
    except AnalysisException:  # not from files, from several tables, or past an aggregation
        return None
