"""From raw documents to a training mix: toxicity, near-duplicates, repeated passages, benchmark leaks, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.llm import decontaminate, mixing, near_dedup, suffix_dedup, toxicity
from modspark.llm.common import keyed, settle, table
from modspark.llm.registry import query
from modspark.operators.joins import is_small, sized_join

# Row numbers of dropped documents that are broadcast (about 50 MB on the driver); more are sorted with the documents.
DROPPED_LIMIT = 1_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on a sample of the labelled ones, does not reject."""
    model = toxicity.label_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    return sized_join(rows, dropped, "_row", "left_anti", is_small(dropped, DROPPED_LIMIT)).select("_all.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the first by id."""
    rows = keyed(docs)
    found = near_dedup.near_duplicate_rows(rows.select("_row", "_id", "_text"), width=5)
    dropped = settle(found.filter("NOT kept").select("_row"))
    return _without(rows, dropped)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document or line of theirs holds already; characters stay whole.

    A document of which nothing is left goes; one that was empty before stays.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = keyed(docs).select(
        "_row", "_text", F.struct(*[F.col(f"_all.`{c}`").alias(c) for c in others]).alias("_others"),
        F.col("_all.text").isNull().alias("_none"), F.col("_all.n_chars").alias("_chars"),
        (F.length("_text") == 0).alias("_empty"),
    )
    kept = suffix_dedup.kept_texts(rows, keep=["_others", "_none", "_chars", "_empty"])
    text = F.when(~F.col("_none"), F.col("_kept"))
    columns = {"text": text, "n_chars": F.when(F.col("_none"), F.col("_chars")).otherwise(F.length(text)).cast("long")}
    return kept.filter((F.col("_kept") != "") | F.col("_empty")).select(
        *[columns.get(c, F.col(f"_others.`{c}`")).alias(c) for c in docs.columns]
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    rows = keyed(docs)
    leaks = decontaminate.contaminated_items(rows, table(spark, sf_dir, "benchmark"))
    dropped = settle(leaks.select("_row").distinct())
    return _without(rows, dropped)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document it takes, with its text, size, source's target and words taken.

    Columns of the documents that are named like one of these four are replaced.
    """
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_all"), "doc_id", "text", "source"
    )
    # Kept with their sizes, so that words are counted once.
    rows = settle(mixing.sized(packed).select("_all", "_source", "_size", "_hash"))
    mixed = mixing.apply_mix(rows, mixing.mix_plan(rows.select("_source", "_size", "_hash"))).filter("taken > 0")
    own = {"size": F.col("_size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": F.col("taken")}
    return mixed.select(
        *[F.col(f"_all.`{c}`").alias(c) for c in docs.columns if c.lower() not in own],
        *[column.alias(name) for name, column in own.items()],
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("source mixing", mix),
]

#: The learned severity and the hash thresholds have no SQL form; tests compare with brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
