"""Toxicity severity: cumulative-link ordinal regression on sparse text features.

``P(grade > k) = 1 / (1 + exp(cut_k - w·x))`` with one weight vector for all ordered thresholds
``cut_0 < cut_1 < ...``; the expected severity is the sum of these probabilities.  Features are
whether a text has a word, or a word with a given beginning of 4, 5 or 6 bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import settle
from modspark.llm.kernels import IS_ALNUM, longs, mix, word_groups

HEADS = (4, 5, 6)
FIT_ROWS = 20_000
N_FEATURES = 4_096
_SALTS = np.array([0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B, 0x510E527FADE682D1], dtype=np.uint64)
_FILTER_BITS = 20


class SeverityModel(NamedTuple):
    """Sorted feature hashes, their weights, and the thresholds of grades 1, 2, ..."""

    features: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray


def _features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For groups of texts: first text, their number, and text and hash of every feature (repeated)."""
    for first, words in word_groups(texts, IS_ALNUM, heads=HEADS):
        text = np.repeat(np.arange(len(words.starts)), words.ends - words.starts)
        where, hashes = [text], [mix(words.hashes ^ _SALTS[0])]
        for k, head in enumerate(words.heads, start=1):
            there = head != 0
            where.append(text[there])
            hashes.append(mix(head[there] ^ _SALTS[k]))
        yield first, len(words.starts), np.concatenate(where), np.concatenate(hashes)


def _once(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    return text[new], feature[new]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, documents of grade 0, documents above), summed over each group of texts."""
    for batch in batches:
        above = batch.column(1).to_numpy(zero_copy_only=False) > 0
        for first, n, text, feature in _features(batch.column(0)):
            text, feature = _once(text, feature)
            names, place = np.unique(feature, return_inverse=True)
            up = np.bincount(place, weights=above[first : first + n][text], minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [longs(names), longs(np.bincount(place, minlength=len(names)) - up), longs(up)], names=["f", "n0", "n1"]
            )


class _Lookup:
    """Numbers of known features; most others are turned away by one look at a bitmap."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.bitmap = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bitmap[self._bucket(features)] = True

    @staticmethod
    def _bucket(x: np.ndarray) -> np.ndarray:
        return (x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def find(self, text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and number of the known features, each once per text."""
        maybe = self.bitmap[self._bucket(feature)]
        text, feature = text[maybe], feature[maybe]
        number = np.minimum(np.searchsorted(self.features, feature), max(0, len(self.features) - 1))
        known = self.features[number] == feature if len(self.features) else np.zeros(0, dtype=bool)
        return _once(text[known], number[known])


def _active(features):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(features.value)
        for batch in batches:
            for first, n, text, feature in _features(batch.column(0)):
                text, number = lookup.find(text, feature)
                offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, n), pa.ListArray.from_arrays(pa.array(offsets), pa.array(number, type=pa.int32()))],
                    names=["grade", "x"],
                )

    return run


def _fit(grades: np.ndarray, text: np.ndarray, number: np.ndarray, n_features: int, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps with momentum scaling, from fixed starting values.

    Thresholds are ``cut_0`` and positive gaps, so they stay in order.
    """
    n, top = len(grades), int(grades.max())
    above = (grades[:, None] > np.arange(top)[None, :]).astype(float)
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(top))
    gaps = np.log(np.maximum(np.diff(start), 1e-3))
    value = np.concatenate([np.zeros(n_features), start[:1], gaps])
    first, second = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, steps + 1):
        w = value[:n_features]
        cuts = np.concatenate([value[n_features : n_features + 1], value[n_features] + np.cumsum(np.exp(value[n_features + 1 :]))])
        score = np.bincount(text, weights=w[number], minlength=n)
        p = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -40, 40)))
        # P(grade) is the difference of neighbouring probabilities; its log's slope by the score and cuts.
        padded = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        row = np.arange(n)
        upper, lower = padded[row, grades], padded[row, grades + 1]
        mass = np.maximum(upper - lower, 1e-9)
        slope_up, slope_low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        by_score = slope_up - slope_low
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grades, -slope_up)
        np.add.at(by_cut, grades + 1, slope_low)
        by_cut = by_cut[1:-1]
        gradient = np.empty_like(value)
        gradient[:n_features] = np.bincount(number, weights=by_score[text], minlength=n_features) / n - penalty * w
        gradient[n_features] = by_cut.sum() / n
        tails = np.cumsum(by_cut[::-1])[::-1][1:]
        gradient[n_features + 1 :] = tails * np.exp(value[n_features + 1 :]) / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        value += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    cuts = np.concatenate([value[n_features : n_features + 1], value[n_features] + np.cumsum(np.exp(value[n_features + 1 :]))])
    return value[:n_features], cuts


def fit_severity(
    labelled: DataFrame, text: str = "text", grade: str = "grade", n_features: int = N_FEATURES,
    min_docs: int = 3, min_z: float = 3.0, penalty: float = 1e-5, steps: int = 300,
) -> SeverityModel:
    """A model of ``grade`` (0, 1, 2, ...) from labelled rows; rows without grade are not used.

    Feature counts are summed in Spark over all given rows.  The ``n_features`` features that differ most
    between grade 0 and above (at least ``min_docs`` documents and a z-score of ``min_z``) make the model.
    The rows, each as its few active features, come to the driver for the fit: give it a bounded
    sample (``sample_labelled``).  With one grade only, or no rows, nothing is ever severe.
    """
    rows = labelled.filter(F.col(grade).isNotNull()).select(
        F.coalesce(text, F.lit("")).alias("t"), F.col(grade).cast("int").alias("g")
    )
    n0, n1 = rows.agg(F.count_if(F.col("g") == 0), F.count_if(F.col("g") > 0)).head()
    nothing = SeverityModel(np.zeros(0, dtype=np.uint64), np.zeros(0), np.array([40.0]))
    if not n0 or not n1:
        return nothing
    counts = rows.mapInArrow(_counted, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p, q = F.col("n1") / n1, F.col("n0") / n0
    pooled = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    z = (p - q) / F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1))
    best = (
        counts.filter((F.col("n0") + F.col("n1") >= min_docs)).withColumn("z", z).filter(F.abs("z") >= min_z)
        .orderBy(F.abs("z").desc(), "f").limit(n_features).select("f").collect()
    )
    if not best:
        return nothing
    features = np.sort(np.array([r[0] for r in best], dtype=np.int64).view(np.uint64))
    shared = rows.sparkSession.sparkContext.broadcast(features)
    active = rows.select("t", "g").mapInArrow(_active(shared), "grade int, x array<int>").collect()
    grades = np.array([r[0] for r in active])
    number = np.array([i for r in active for i in r[1]], dtype=np.int64)
    where = np.repeat(np.arange(len(active)), [len(r[1]) for r in active])
    # The same fit whatever the order of the rows.
    keys = [(int(g), tuple(r[1])) for g, r in zip(grades, active, strict=True)]
    if keys != sorted(keys):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        grades = grades[order]
        number = np.array([i for k in order for i in active[k][1]], dtype=np.int64)
        where = np.repeat(np.arange(len(active)), [len(active[k][1]) for k in order])
    weights, cuts = _fit(grades, where, number, len(features), penalty, steps)
    return SeverityModel(features, weights, cuts)


def sample_labelled(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``(text, toxic)`` of about ``fit_rows`` labelled documents, those of smallest hash of their id.

    The bound keeps the fit on one machine; the ids of the sample are few enough to broadcast.
    """
    known = labels.filter(F.col(toxic).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_labelled"), F.col(toxic).alias("_toxic")
    )
    n = known.count()
    share = F.pmod(F.xxhash64("_labelled"), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, fit_rows / max(1, n)))
    return documents.select(F.col(id_col).alias("_labelled"), F.col(text).alias("text")).join(
        F.broadcast(known.filter(share)), "_labelled"
    ).select("text", F.col("_toxic").alias("toxic"))


def graded(sample: DataFrame, min_docs: int = 3, min_z: float = 3.0) -> DataFrame:
    """Severity grades for labels that only tell toxic from not.

    A toxic text has grade 1; 2 from three, and 3 from six different marker features on.  Markers are
    features that are ten times as frequent in toxic texts; they are found as in ``fit_severity``.
    """
    rows = settle(sample.select(F.coalesce("text", F.lit("")).alias("t"), (F.col("toxic") > 0).cast("int").alias("g")))
    n0, n1 = rows.agg(F.count_if(F.col("g") == 0), F.count_if(F.col("g") > 0)).head()
    counts = rows.mapInArrow(_counted, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = F.col("n1") / max(n1, 1) > 10 * F.col("n0") / max(n0, 1)
    found = counts.filter(share & (F.col("n1") >= min_docs)).orderBy(F.col("n1").desc(), "f").limit(N_FEATURES).select("f").collect()
    features = np.sort(np.array([r[0] for r in found], dtype=np.int64).view(np.uint64))
    shared = rows.sparkSession.sparkContext.broadcast(features)

    def grade(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for first, n, text, feature in _features(batch.column(0)):
                own, _ = lookup.find(text, feature)
                markers = np.bincount(own, minlength=n)
                level = (1 + (markers >= 3) + (markers >= 6)) * toxic[first : first + n]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(level, type=pa.int32())], names=["text", "grade"]
                )

    return settle(rows.mapInArrow(grade, "text string, grade int"))


def _scored(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: SeverityModel = model.value
        lookup = _Lookup(known.features)
        for batch in batches:
            keep = [c for c in batch.schema.names if c != "_text"]
            for first, n, text, feature in _features(batch.column("_text")):
                own, number = lookup.find(text, feature)
                score = np.bincount(own, weights=known.weights[number], minlength=n)
                p = 1 / (1 + np.exp(np.clip(known.cuts[None, :] - score[:, None], -700, 700)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, n) for c in keep), pa.array(p.sum(axis=1)), pa.array(p[:, 0]),
                     pa.array((p > 0.5).sum(axis=1), type=pa.int32()), pa.array(p[:, 0] >= 0.5)],
                    names=[*keep, "severity", "p_toxic", "grade", "toxic"],
                )

    return run


SCORES = "severity double, p_toxic double, grade int, toxic boolean"


def severity_scores(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, expected ``severity``, ``p_toxic`` (of any grade above 0), ``grade``
    (thresholds passed with more than even odds) and ``toxic`` (``p_toxic`` of at least a half).

    A missing or empty text has no features and gets the model's base rate.  Rows are scored in place
    and each on its own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text")).mapInArrow(
        _scored(shared), f"_id long, {SCORES}"
    ).withColumnRenamed("_id", id_col)


def drop_toxic(docs: DataFrame, model: SeverityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, that the model does not call toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_all"), docs[f"`{text}`"].alias("_text"))
    kind = packed.schema["_all"].dataType.simpleString()
    return packed.mapInArrow(_scored(shared), f"_all {kind}, {SCORES}").filter("NOT toxic").select("_all.*")


def label_model(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic", fit_rows: int = FIT_ROWS) -> SeverityModel:
    """A model from toxic/clean labels: bounded sample, grades, fit."""
    return fit_severity(graded(sample_labelled(documents, labels, id_col, text, toxic, fit_rows)))
