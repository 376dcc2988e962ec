"""Words and phrases looked up in the row: one trie over words for all classes and languages.

The trie is broadcast after a size check.  Inside a task the words of all texts of a batch are numbered
at once, and all places of a batch step through the trie together, so nothing is done word by word.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from modspark.workers import ship_library

ANY = "*"


class WordTrie:
    """Phrases as ways of word numbers.  ``edges`` holds state * words + word in order, ``targets`` where it leads."""

    def __init__(self, phrases: Sequence[tuple[str, ...]]):
        number: dict[str, int] = {}
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for i, phrase in enumerate(phrases):
            state = 0
            for w in phrase:
                key = (state, number.setdefault(w, len(number)))
                state = edges.setdefault(key, len(edges) + 1)
            ends[state] = i
        self.words = pa.array(list(number), type=pa.string())
        keys = np.array([s * max(1, len(number)) + w for s, w in edges], dtype=np.int64)
        order = np.argsort(keys)
        self.edges, self.targets = keys[order], np.array(list(edges.values()), dtype=np.int64)[order]
        self.ends = np.full(len(edges) + 1, -1, dtype=np.int64)
        for state, i in ends.items():
            self.ends[state] = i

    def _step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        key = state * max(1, len(self.words)) + word
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where((word >= 0) & (self.edges[at] == key), self.targets[at], -1)

    def places(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, word place, phrase)`` for every place of a batch where a phrase stands, overlaps included."""
        ids, row, stop = numbered(tokens, self.words)
        found = [np.zeros((3, 0), dtype=np.int64)]
        if len(self.edges) and len(ids):
            start = np.flatnonzero(ids >= 0)
            state, depth = np.zeros(len(start), dtype=np.int64), 0
            while len(start):
                state = self._step(state, ids[start + depth])
                start, state, depth = start[state >= 0], state[state >= 0], depth + 1
                end = self.ends[state] >= 0
                found.append(np.stack([row[start[end]], start[end], self.ends[state[end]]]))
                more = start + depth < stop[start]
                start, state = start[more], state[more]
        return tuple(np.concatenate(found, axis=1))


def numbered(tokens: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch of word lists: their numbers in ``words`` or -1, their rows, their rows' ends."""
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0)).astype(np.int64)
    ids = np.asarray(pc.fill_null(pc.index_in(tokens.flatten(), value_set=words), -1)).astype(np.int64)
    ends = np.cumsum(sizes)
    return ids, np.repeat(np.arange(len(sizes)), sizes), np.repeat(ends, sizes)


class Lexicon:
    """Phrases with the classes and languages that they count for."""

    def __init__(self, entries: Sequence[tuple[int, tuple[str, ...], str]]):
        """``entries``: (class number, phrase, language or ``*``)."""
        self.phrases = sorted({p for _, p, _ in entries})
        place = {p: i for i, p in enumerate(self.phrases)}
        self.trie = WordTrie(self.phrases)
        self.langs = {ANY: 0}
        rows = sorted({(place[p], c, self.langs.setdefault(code, len(self.langs))) for c, p, code in entries})
        at = np.array(rows, dtype=np.int64).reshape(-1, 3)
        self.classes, self.codes = at[:, 1], at[:, 2]
        self.begin = np.searchsorted(at[:, 0], np.arange(len(self.phrases) + 1))

    def hits(self, tokens: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, phrase, class)``, once for every place and class, whether listed for ``*``, the language or both."""
        row, place, phrase = self.trie.places(tokens)
        if not len(row):
            return row, phrase, row
        own = np.array([self.langs.get(x, -1) for x in langs.take(pa.array(row)).to_pylist()], dtype=np.int64)
        n = self.begin[phrase + 1] - self.begin[phrase]
        which = np.repeat(np.arange(len(row)), n)
        entry = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + self.begin[phrase[which]]
        fits = (self.codes[entry] == 0) | (self.codes[entry] == own[which])
        which, entry = which[fits], entry[fits]
        at = np.unique(np.stack([which, self.classes[entry]]), axis=1)  # a place counts once for a class
        return row[at[0]], phrase[at[0]], at[1]


def class_counts(spark: SparkSession, entries: Sequence[tuple[int, tuple[str, ...], str]], n_classes: int, tokens: Column, lang: Column) -> Column:
    """An array with the hits of each class."""
    ship_library(spark)
    shared = spark.sparkContext.broadcast(Lexicon(entries))

    @F.arrow_udf("array<int>")
    def counted(words: pa.Array, langs: pa.Array) -> pa.Array:
        row, _, cls = shared.value.hits(words, langs)
        n = np.bincount(row * n_classes + cls, minlength=len(words) * n_classes).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * n_classes), pa.array(n))

    return counted(tokens, lang)


def phrase_hits(
    spark: SparkSession, entries: Sequence[tuple[int, tuple[str, ...], str]], tokens: Column, lang: Column
) -> Column:
    """``array<struct<class:int, phrase:string, n:int>>``: how often each phrase counts for each class."""
    ship_library(spark)
    shared = spark.sparkContext.broadcast(Lexicon(entries))

    @F.arrow_udf("array<struct<class:int,phrase:string,n:int>>")
    def found(words: pa.Array, langs: pa.Array) -> pa.Array:
        lexicon = shared.value
        hits = np.stack(lexicon.hits(words, langs))
        at, n = np.unique(hits, axis=1, return_counts=True) if hits.shape[1] else (hits, np.zeros(0, dtype=np.int64))
        items = pa.StructArray.from_arrays(
            [pa.array(at[2].astype(np.int32)), pa.array([" ".join(lexicon.phrases[p]) for p in at[1]], type=pa.string()),
             pa.array(n.astype(np.int32))], names=["class", "phrase", "n"],
        )
        offsets = np.searchsorted(at[0], np.arange(len(words) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), items)

    return found(tokens, lang)


def word_sums(spark: SparkSession, words: Sequence[str], weights: np.ndarray, tokens: Column) -> Column:
    """An array: how many of a text's words are in ``words``, and for each column of ``weights`` their sum."""
    ship_library(spark)
    shared = spark.sparkContext.broadcast((pa.array(words, type=pa.string()), np.asarray(weights, dtype=np.float64)))

    @F.arrow_udf("array<double>")
    def summed(texts: pa.Array) -> pa.Array:
        known, matrix = shared.value
        ids, row, _ = numbered(texts, known)
        row, ids = row[ids >= 0], ids[ids >= 0]
        columns = [np.bincount(row, minlength=len(texts))]
        columns += [np.bincount(row, weights=matrix[ids, k], minlength=len(texts)) for k in range(matrix.shape[1])]
        flat = np.stack(columns, axis=1).astype(np.float64).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(columns)), pa.array(flat))

    return summed(tokens)
