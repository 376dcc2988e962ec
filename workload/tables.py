"""Loading the tables, and lexicons that occur in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modspark import defaults


def load(spark: SparkSession, sf_dir: str, name: str, spread: str | None = None) -> DataFrame:
    """Read a table.  ``spread`` names a unique column to hash over the cores when the table is
    stored in fewer pieces than there are cores; a large table has more and is read as it is."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            return df.repartition(cores, spread)
    return df


def spread_files(df: DataFrame, key: str) -> DataFrame:
    """Rows that become a file each, dealt to several tasks for every core: by bytes they would fill a few."""
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, key)


# Words and phrases of the invented corpus prose, so that the checks see hits.
PROFILES = [
    (lang, word)
    for lang, words in {
        "en": "the of and to is that it",
        "de": "der die und den von zu das",
        "fr": "le et les des du une est",
        "es": "el los y del se por con",
    }.items()
    for word in words.split()
]

SENTIMENTS = [
    ("positive", "with", "en"), ("positive", "are", "en"), ("positive", "for", "en"),
    ("positive", "mit", "de"), ("positive", "avec", "fr"), ("positive", "con", "es"),
    ("negative", "worthless", "*"), ("negative", "pathetic", "*"), ("negative", "disgusting", "*"),
    ("negative", "was", "en"), ("negative", "not", "en"), ("negative", "by", "en"),
    ("negative", "nicht", "de"), ("negative", "pas", "fr"), ("negative", "no", "es"),
]

TOXIC = [
    ("insult", "idiot", "*"), ("insult", "moron", "*"), ("insult", "clown", "*"),
    ("insult", "loser", "*"), ("insult", "stupid", "*"),
    ("profanity", "trash", "en"), ("hate_speech", "scum", "en"),
    ("harassment_or_abuse", "worthless", "*"), ("harassment_or_abuse", "pathetic", "*"),
    ("graphic", "disgusting", "en"), ("violence_or_threat", "hest", "en"), ("sexual", "orin", "en"),
    ("sexual", "beer", "en"),
]

PHRASES = [
    *defaults.POLICY_PHRASES,
    (3, "Violence", "of the in", "en"),
    (3, "Violence", "hest", "en"),
    (3, "Violence", "is the", "en"),
    (6, "Drugs", "the the the", "en"),
    (6, "Drugs", "of la", "*"),
    (6, "Drugs", "la", "fr"),
    (8, "Alcohol", "beer", "en"),
    (8, "Alcohol", "et la", "fr"),
    (5, "Rude Gestures", "idiot", "*"),
    (5, "Rude Gestures", "der die", "de"),
    (10, "Hate Symbols", "scum", "*"),
    (10, "Hate Symbols", "in to a the", "en"),
]
