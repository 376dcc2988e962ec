"""Word-count naive Bayes: a model as two tables, scored in the row or, if it is too large to broadcast,
by a join of the different words of blocks of texts."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.functions import text as T
from modspark.operators import automaton
from modspark.operators.joins import BROADCAST_BYTES, lookup_join
from modspark.operators.rows import compute_once, with_row_id
from modspark.scratch import settle
from modspark.workers import ship_library

MAX_CLASSES = 1000
# Words of a block of texts, which meets a model too large to broadcast together.
BLOCK_WORDS = 4_000_000


class ClassifierModel(NamedTuple):
    """``classes``: (class, n_docs, n_words).  ``words``: (word, class, n)."""

    classes: DataFrame
    words: DataFrame


def fit_classifier(
    labelled: DataFrame, text: str = "text", label: str = "label", save_to: str | None = None
) -> ClassifierModel:
    """Count words per class.  Both counts are combined inside each task before the shuffle.

    ``save_to`` writes the two tables and reads them back, so that scoring does not count again.
    """
    docs = labelled.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("class"), F.col(text).alias("_text")
    )
    words = (
        docs.select("class", F.explode(T.tokens(F.col("_text"))).alias("word"))
        .groupBy("word", "class")
        .agg(F.count("*").alias("n"))
    )
    if save_to is not None:
        words.write.mode("overwrite").parquet(f"{save_to}/words")
        words = labelled.sparkSession.read.schema(words.schema).parquet(f"{save_to}/words")
    # Only labels and word counts are read again; the texts are split once.
    n_docs = docs.groupBy("class").agg(F.count("*").alias("n_docs"))
    n_words = words.groupBy("class").agg(F.sum("n").alias("n_words"))
    classes = n_docs.join(n_words, "class", "left").select(
        "class", "n_docs", F.coalesce("n_words", F.lit(0)).cast("bigint").alias("n_words")
    )
    if save_to is not None:
        classes.write.mode("overwrite").parquet(f"{save_to}/classes")
        return load_classifier(labelled.sparkSession, save_to)
    return ClassifierModel(classes, words)


def load_classifier(spark: SparkSession, path: str) -> ClassifierModel:
    return ClassifierModel(spark.read.parquet(f"{path}/classes"), spark.read.parquet(f"{path}/words"))


def prompt_safety(
    df: DataFrame, model: ClassifierModel, text: str = "text", id_col: str | None = None, digits: int = 4
) -> DataFrame:
    """Add ``prompt_class``, ``prompt_score`` (its share of the probability) and ``prompt_log_score``.

    Laplace smoothing by 1; words the model has not seen are left out; at log scores equal to
    ``digits`` decimals the larger class name wins.  Every row is scored on its own, also rows whose
    ids repeat or are missing; ``id_col`` is accepted and not needed.
    """
    scorer = PromptScorer(model)
    if scorer.small:
        return scorer.with_class(scorer.with_sums(df, T.tokens(F.col(text))), digits)
    rows = with_row_id(df)
    joined = rows.join(scorer.word_sums(rows.select("_rid", text), text), "_rid", "left")
    return scorer.with_class(joined, digits).drop("_rid")


class PromptScorer:
    """A model made ready: sums of word scores per row, and the class they lead to."""

    def __init__(self, model: ClassifierModel):
        self.classes = [tuple(r) for r in model.classes.select("class", "n_docs", "n_words")
                        .orderBy("class").limit(MAX_CLASSES + 1).collect()]
        if len(self.classes) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        self.gain = {r[0]: f"_g{i}" for i, r in enumerate(self.classes)}

        def gained(c: str):
            n = F.max(F.when(F.col("class") == c, F.col("n")))
            return F.log(F.coalesce(n, F.lit(0)) + 1.0)

        self.vocabulary = model.words.groupBy("word").agg(*[gained(c).alias(g) for c, g in self.gain.items()])
        self.n_vocabulary, letters = self.vocabulary.agg(
            F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))
        ).head()
        self.small = letters + self.n_vocabulary * 8 * (len(self.classes) + 2) <= BROADCAST_BYTES

    def with_sums(self, df: DataFrame, tokens: Column) -> DataFrame:
        """Add ``_n`` and a sum per class in the row: known words times weights, the model broadcast."""
        model = self.vocabulary.toArrow()
        weights = np.column_stack([np.asarray(model.column(g)) for g in self.gain.values()])
        found = automaton.word_sums(df.sparkSession, model.column("word").combine_chunks(), weights, tokens)
        return compute_once(df, _sums=found).withColumns(
            {"_n": F.get("_sums", F.lit(0)).cast("long")}
            | {g: F.get("_sums", F.lit(i)) for i, g in enumerate(self.gain.values(), 1)}
        ).drop("_sums")

    def word_sums(self, rows: DataFrame, text: str) -> DataFrame:
        """``_rid``, ``_n`` and a sum per class, for the rows that have known words.

        With a broadcast model the sums of a text are complete before the shuffle.  A larger model is joined
        with the different words of every block of texts, not with each word of each text.
        """
        if not self.small:
            return self._sums_by_block(rows, text)
        in_text = rows.select("_rid", F.explode(T.tokens(F.col(text))).alias("word"))
        known = lookup_join(in_text, self.vocabulary, "word", ["_rid"], "inner", small=True)
        return known.groupBy("_rid").agg(
            F.count("*").alias("_n"), *[F.sum(g).alias(g) for g in self.gain.values()]
        )

    def _sums_by_block(self, rows: DataFrame, text: str) -> DataFrame:
        blocks = word_blocks(rows, text)
        words = blocks.select(F.col("block").alias("of_block"), F.posexplode("words").alias("place", "word"))
        known = words.join(self.vocabulary, "word").drop("word")
        gains = list(self.gain.values())

        def summed(block: pa.Table, found: pa.Table) -> pa.Table:
            rids, width = block["rids"].combine_chunks().flatten(), block["width"][0].as_py()
            place = np.asarray(found["place"])
            at = np.cumsum(_unpacked(block["gaps"][0]))
            row, word, times = at // width, at % width, _unpacked(block["times"][0])

            def sums(weights) -> np.ndarray:
                of_word = np.zeros(width)
                of_word[place] = weights
                return np.bincount(row, weights=times * of_word[word], minlength=len(rids))

            count = sums(1.0).astype(np.int64)
            some = pa.array(np.flatnonzero(count))
            columns = [pa.array(count), *[pa.array(sums(np.asarray(found[g]))) for g in gains]]
            return pa.table([rids.take(some), *[c.take(some) for c in columns]], names=["_rid", "_n", *gains])

        kind = dict(rows.dtypes)["_rid"]
        schema = ", ".join([f"_rid {kind}", "_n long", *[f"{g} double" for g in gains]])
        texts = blocks.drop("words")
        return texts.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(summed, schema)

    def with_class(self, df: DataFrame, digits: int = 4) -> DataFrame:
        n_docs = sum(r[1] for r in self.classes)
        scores = F.array(
            *[
                F.struct(
                    F.round(
                        F.log(F.lit(docs / n_docs))
                        + F.coalesce(F.col(self.gain[c]), F.lit(0.0))
                        - F.coalesce(F.col("_n"), F.lit(0)) * F.log(F.lit(float(words + self.n_vocabulary))),
                        digits,
                    ).alias("score"),
                    F.lit(c).alias("class"),
                )
                for c, docs, words in self.classes
            ]
        )
        best = F.array_max("_scores")
        share = 1.0 / F.aggregate(
            "_scores", F.lit(0.0), lambda acc, s: acc + F.exp(s["score"] - F.col("_best")["score"])
        )
        return (
            df.withColumn("_scores", scores)
            .withColumn("_best", best)
            .withColumns(
                {
                    "prompt_class": F.col("_best")["class"],
                    "prompt_score": share,
                    "prompt_log_score": F.col("_best")["score"],
                }
            )
            .drop("_scores", "_best", "_n", *self.gain.values())
        )


def word_blocks(rows: DataFrame, text: str, block_words: int | None = None) -> DataFrame:
    """Texts in blocks of about ``block_words`` words, a row each, written out.

    ``words`` are the different words of the block and ``rids`` its rows' ids.  How often a text has a word
    stands packed in ``times``, at places row * ``width`` + word that grow by ``gaps``.
    """
    ship_library(rows.sparkSession)
    limit = block_words or BLOCK_WORDS

    def pack(batches):
        held, n, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(np.asarray(pc.list_value_length(batch.column(1))))
            at = 0
            while at < len(ends):
                before = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, before + limit - n, side="right")))
                held.append(batch.slice(at, stop - at))
                n, at = n + int(ends[stop - 1] - before), stop
                if n >= limit or at < len(ends):
                    yield _packed(held, number)
                    held, n, number = [], 0, number + 1
        if held:
            yield _packed(held, number)

    kind = dict(rows.dtypes)["_rid"]
    schema = f"block long, width long, words array<string>, rids array<{kind}>, gaps binary, times binary"
    return settle(rows.select("_rid", T.tokens(F.col(text)).alias("words")).mapInArrow(pack, schema))


def _packed(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    rids, lists = table.column(0).combine_chunks(), table.column(1).combine_chunks()
    coded = pc.dictionary_encode(lists.flatten())
    words = coded.dictionary
    width = max(1, len(words))
    row = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
    at, times = np.unique(row * width + np.asarray(coded.indices), return_counts=True)

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], type=pa.int32()), values)

    size = (8 * len(at)).to_bytes(8, "little")
    packed = [size + pa.compress(x.astype(np.int64).tobytes(), codec="zstd", asbytes=True) for x in (np.diff(at, prepend=0), times)]
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([width]), one(words), one(rids), *[pa.array([x], type=pa.binary()) for x in packed]],
        names=["block", "width", "words", "rids", "gaps", "times"],
    )


def _unpacked(value: pa.Scalar) -> np.ndarray:
    data = value.as_py()
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), dtype=np.int64)
