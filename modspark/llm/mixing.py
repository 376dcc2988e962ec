"""Mixing sources to target weights by nested thresholds on a hash, without sorting documents.

Sizes are summed by source and hash bucket; the bucket in which a source's budget runs out is the
only one that is divided further.  A document is in the mix if its hash lies below its source's
threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modspark.llm.common import WORD_GAP, ranked, settle
from modspark.operators.joins import lookup_join

HASH_BITS = 60
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    """Number of words; runs between blanks, so one more than the gaps inside the trimmed text."""
    solid = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{WORD_GAP}", "")
    ends = F.regexp_count(solid, F.lit(r"[^\x20\x09-\x0D]([\x20\x09-\x0D]|\z)"))
    return ends.cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Add ``_source`` (sorts like the source, missing last), ``_size`` in words and ``_hash``."""
    return docs.withColumns({
        "_source": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("￿")),
        "_size": word_count(F.col(text)),
        "_hash": F.shiftrightunsigned(F.xxhash64(id_col, source, text), 64 - HASH_BITS),
    })


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``_source, _source_size, _target`` from ``sizes`` (``_source, _source_size``), one row each.

    Sources in code point order take the weights in turn and share ``share`` times all sizes.  No
    target exceeds ``most`` times its source's size; what is above is shared again by weight among
    the others, until none is above.  That is ``min(cap, level * weight)`` with one level for all,
    found by raising it; each round is one sum over the sources.
    """
    weight = F.lit([float(w) for w in weights])
    shares = ranked(sizes, "_source").select(
        "_source", "_source_size", (most * F.col("_source_size")).cast("double").alias("_cap"),
        F.get(weight, F.pmod("_rank", F.lit(len(weights))).cast("int")).alias("_weight"),
    )
    shares = settle(shares)
    total = float(shares.agg(F.sum("_source_size")).head()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        capped = F.col("_cap") < level * F.col("_weight")
        n, held, free = shares.agg(
            F.count_if(capped), F.coalesce(F.sum(F.when(capped, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0.0)),
        ).head()
        if n == full or not free:
            break
        full, level = n, (total - held) / free
    return shares.select(
        "_source", "_source_size",
        F.least("_cap", F.lit(level) * F.col("_weight")).alias("_target"),
    )


def mix_plan(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: its target, whole copies of everything, and the threshold of the rest.

    ``rows`` has ``_source, _size, _hash``, kept in a table.  A document is taken ``_whole`` times,
    and once more if its hash is below the threshold: ``_hash >> _shift < _prefix``, or equal to it if
    ``_edge``.  After five levels a bucket is one hash value; what shares it is taken together, and
    it is taken if that brings the source nearer to its target.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    whole = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    plan = settle(
        source_targets(sizes, weights, share, most).withColumn("_whole", whole.cast("long"))
        .withColumns({
            "_left": F.greatest(F.lit(0.0), F.col("_target") - F.col("_whole") * F.col("_source_size")),
            "_prefix": F.lit(0).cast("long"), "_shift": F.lit(HASH_BITS), "_edge_size": F.lit(0).cast("long"),
        })
    )
    inside = rows
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        state = plan.select("_source", "_prefix", "_left", "_shift")
        # Rows of the boundary bucket only; at first that is everything.
        edge = lookup_join(inside, state, "_source", ["_hash"], "inner").filter(
            F.shiftright("_hash", shift + LEVEL_BITS) == F.col("_prefix")
        ).select("_source", "_size", "_hash")
        inside = settle(edge) if shift + LEVEL_BITS < HASH_BITS else edge
        histogram = inside.groupBy("_source", F.shiftright("_hash", shift).alias("_bucket")).agg(
            F.sum("_size").alias("_n"), F.count("*").alias("_rows")
        )
        up_to = Window.partitionBy("_source").orderBy("_bucket")  # at most 4,096 buckets a source
        running = histogram.withColumn("_upto", F.sum("_n").over(up_to))
        reached = lookup_join(running, state.select("_source", "_left"), "_source", ["_bucket"], "inner")
        first = reached.filter(F.col("_upto") > F.col("_left")).groupBy("_source").agg(
            F.min(F.struct("_bucket", "_n", "_upto", "_rows")).alias("_at")
        )
        at = F.col("_at")
        plan = settle(
            plan.join(first, "_source", "left").select(
                "_source", "_source_size", "_target", "_whole",
                F.when(at.isNull(), F.col("_left")).otherwise(F.col("_left") - (at["_upto"] - at["_n"])).alias("_left"),
                # A source whose budget no bucket exhausts takes them all.
                F.when(at.isNull(), (F.col("_prefix") + 1) * 2**LEVEL_BITS).otherwise(at["_bucket"]).alias("_prefix"),
                F.lit(shift).alias("_shift"), F.coalesce(at["_n"], F.lit(0).cast("long")).alias("_edge_size"),
                F.coalesce(at["_rows"], F.lit(0).cast("long")).alias("_rows"),
            )
        )
        if not plan.filter(F.col("_rows") > 1).limit(1).count():
            break
        plan = plan.drop("_rows")
    nearer = F.col("_left") * 2 > F.col("_edge_size")
    return plan.select(
        "_source", "_source_size", "_target", "_whole", "_prefix", "_shift", nearer.alias("_edge")
    )


def apply_mix(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` (in words) to rows made by ``sized``."""
    place = F.expr("shiftright(_hash, _shift)")
    below = (place < F.col("_prefix")) | (F.col("_edge") & (place == F.col("_prefix")))
    joined = lookup_join(rows, plan, "_source", ["_hash"], "left")
    return joined.withColumns({
        "source_size": F.col("_source_size"), "target": F.col("_target"),
        "taken": F.col("_size") * (F.col("_whole") + F.when(below, 1).otherwise(0)),
    }).drop("_source_size", "_target", "_whole", "_prefix", "_shift", "_edge")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken``.

    The choice depends on hashes of (id, source, text) alone, so reruns agree.  A missing or empty
    text has size 0 and is taken 0 words; a missing source is a source of its own; rows that are
    equal in id, source and text are taken together.  An empty table gives an empty result.
    """
    rows = settle(sized(docs, id_col, text, source).select(F.col(id_col).alias("_id"), "_source", "_size", "_hash"))
    mixed = apply_mix(rows, mix_plan(rows, weights, share, most))
    return mixed.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", "taken")
