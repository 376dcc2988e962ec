"""Phrase collocations from counts of the longest windows alone.

Every word opens one window: itself and the words after it in its piece as lead columns, padded where
the piece ends.  Distinct windows are counted once; ROLLUP over the columns sums them to the
counts of all their prefixes, so no n-grams of another length are ever made from the texts.

Neighbouring words that together are rarer than the least count end a window, as no phrase that is
kept holds them.  Which pairs, and triples of such pairs, may be frequent is known from counts of their
hashes, kept as bit sets of bounded size: those may let rare ones pass, never cut a frequent one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modspark.llm.common import freed_shuffles, settle
from modspark.llm.kernels import LOWER_VALUES, Slices, longs, mix, text_bytes
from modspark.operators.joins import lookup_join

GROUP_BYTES = 1 << 21
KEPT_GRAMS = 400_000
SIEVE_BITS = 1 << 29
BITS_FOR_EACH = 16
BLOCK_BITS = 1 << 16
SALTS = 32

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _parts(column: pa.Array, words_ahead: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """``(bytes, starts of texts, numbers of texts, own)``: whole texts of together ``limit`` bytes, and parts
    of longer ones.  Windows that start before byte ``own`` belong to the part; what follows it, at
    most ``words_ahead`` words, is there for them to look at."""
    data, at = text_bytes(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = max(int(np.searchsorted(at, at[first] + limit, side="right")) - 1, first + 1)
        begin, end = int(at[first]), int(at[last])
        if end - begin <= limit:
            yield data[begin:end], at[first:last] - begin, np.arange(first, last), end - begin
        else:
            while begin < end:
                stop, ahead = _cut(data, begin, end, limit, words_ahead)
                yield data[begin:ahead], np.zeros(1, dtype=np.int64), np.array([first]), stop - begin
                begin = stop
        first = last


def _cut(data: np.ndarray, begin: int, end: int, limit: int, words_ahead: int) -> tuple[int, int]:
    """Where a part ends, behind a sign that ends a piece or else behind a blank, and how far it must see."""
    if end - begin <= limit:
        return end, end
    here = data[begin:begin + limit]
    for kind in (_ENDS, _GAPS):
        places = np.flatnonzero(kind[here])
        if len(places):
            stop = begin + int(places[-1]) + 1
            return (stop, stop) if kind is _ENDS else (stop, _after_words(data, stop, end, words_ahead))
    stop = _after_words(data, begin, end, 1)  # one endless word
    return stop, _after_words(data, stop, end, words_ahead)


def _after_words(data: np.ndarray, begin: int, end: int, n: int) -> int:
    """The place behind the next ``n`` words, or behind the piece's end if that comes first."""
    p, step = begin, 4096
    while True:
        part = data[begin:min(end, p + step)]
        gap = _GAPS[part]
        word_ends = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
        stops = np.flatnonzero(_ENDS[part])
        if len(stops) and (len(word_ends) < n or stops[0] <= word_ends[n - 1]):
            return begin + int(stops[0]) + 1
        if len(word_ends) >= n:
            return begin + int(word_ends[n - 1])
        if p + step >= end:
            return end
        p, step = p + step, 2 * step


class _Leads:
    """The words of a part with the hashes of the words that follow them in their pieces, 0 for padding."""

    def __init__(self, part: tuple, langs: np.ndarray, longest: int):
        data, text_starts, texts, own = part
        word = ~_GAPS[data]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        starts = word & ~before
        text_starts = text_starts[text_starts < len(data)]
        starts[text_starts] = word[text_starts]
        begin = np.flatnonzero(starts)
        ends = np.empty_like(word)
        ends[:-1] = word[:-1] & (~word[1:] | starts[1:])
        ends[-1:] = word[-1:]
        end = np.flatnonzero(ends) + 1
        breaks = _ENDS[data].astype(np.int64)
        np.add.at(breaks, text_starts, 1)
        piece = np.cumsum(breaks)[begin]
        # Texts without words start where others do; the last of equal starts owns the words.
        text = np.searchsorted(text_starts, begin, side="right") - 1
        hashes = Slices(data, LOWER_VALUES).hashes(begin, end)
        hashes[hashes == 0] = 1
        self.data, self.own = data, int(np.searchsorted(begin, own))
        n = len(begin)
        self.begin, self.end = (np.concatenate([x, np.zeros(longest, dtype=np.int64)]) for x in (begin, end))
        self.lang = langs[texts[text]][:self.own] if n else np.zeros(0, dtype=langs.dtype)
        padded = np.concatenate([hashes, np.zeros(longest, dtype=np.uint64)])
        pieces = np.concatenate([piece, np.full(longest, -1)])
        self.words = np.zeros((longest, self.own), dtype=np.uint64)
        for k in range(longest):
            same = pieces[k:k + self.own] == piece[:self.own]
            self.words[k] = np.where(same, padded[k:k + self.own], 0)

    def grams(self, size: int, langs: np.ndarray, shift: int = 0, begin: int = 0) -> np.ndarray:
        """Hashes of ``size`` words from word ``shift`` of each window on, with its language."""
        out = self.words[shift][begin:] + langs[self.lang[begin:]]
        for k in range(1, size):
            out = mix(out) * _MULTIPLIERS[0] + self.words[shift + k][begin:] * _MULTIPLIERS[1]
        return mix(out)

    def kept(self, langs: np.ndarray, bitsets: list[np.ndarray]) -> np.ndarray:
        """How many words of each window are left when it is cut before the first pair, triple, ... that
        does not pass.  ``bitsets``: those of 2 words, of 3 words, ..."""
        kept, open_ = np.ones(self.own, dtype=np.int64), np.ones(self.own, dtype=bool)
        first = [may_pass(bits, self.grams(size, langs)) for size, bits in enumerate(bitsets, 2) if size <= len(self.words)]
        for m in range(2, len(self.words) + 1):
            open_ &= self.words[m - 1] != 0
            for size in range(2, min(m, len(first) + 1) + 1):
                shift = m - size
                passes = first[size - 2]
                if shift:  # behind the part's own words only the windows themselves can look
                    near = max(0, self.own - shift)
                    passes = np.concatenate([passes[shift:], may_pass(bitsets[size - 2], self.grams(size, langs, shift, near))])
                open_ &= passes
            kept[open_] = m
        return kept


def _lang_hashes(names: list[str]) -> np.ndarray:
    data, at = text_bytes(pa.array(names, type=pa.string()))
    return Slices(data).hashes(at[:-1], at[1:])


def _batches(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[tuple[_Leads, list[str], np.ndarray]]:
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("_lang").dictionary_encode()
        names = coded.dictionary.to_pylist()
        langs = np.asarray(coded.indices).astype(np.int64)
        hashes = _lang_hashes(names)
        for part in _parts(batch.column("_text"), longest - 1, GROUP_BYTES):
            yield _Leads(part, langs, longest), names, hashes


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _gram_counts(size: int, bitsets: list):
    """``(gram, n)``: hashes of ``size`` neighbouring words, summed in a task as far as ``KEPT_GRAMS`` allow."""

    def out(keys, counts):
        key, n = _summed(keys, counts)
        for p in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays([longs(key[p:p + 100_000]), pa.array(n[p:p + 100_000])], names=["gram", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value for b in bitsets]
        keys, counts, held = [], [], 0
        for leads, _, langs in _batches(batches, size):
            whole = leads.kept(langs, bits) == size
            key, n = np.unique(leads.grams(size, langs)[whole], return_counts=True)
            keys.append(key)
            counts.append(n.astype(np.int64))
            held += len(key)
            if held > 2 * KEPT_GRAMS:
                keys, counts = ([x] for x in _summed(keys, counts))
                held = len(keys[0])
                if held > KEPT_GRAMS:
                    yield from out(keys, counts)
                    keys, counts, held = [], [], 0
        if held:
            yield from out(keys, counts)

    return run


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``(block, bit)`` in order of blocks: ``(block, bits)``, a block's bits as bytes."""
    now, bits = None, np.zeros(BLOCK_BITS, dtype=bool)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now], type=pa.int64()), pa.array([np.packbits(bits).tobytes()], type=pa.binary())], names=["block", "bits"]
        )

    for batch in batches:
        blocks, places = np.asarray(batch.column("block")), np.asarray(batch.column("bit"))
        for begin in np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(blocks) else ():
            end = int(np.searchsorted(blocks, blocks[begin], side="right"))
            if blocks[begin] != now:
                if now is not None:
                    yield out()
                now = int(blocks[begin])
                bits[:] = False
            bits[places[begin:end]] = True
    if now is not None:
        yield out()


class Sieve:
    """A bit set of hashes, at most ``SIEVE_BITS`` bits however many hashes there are."""

    def __init__(self, hashes: DataFrame):
        n = hashes.count()
        self.bits = BLOCK_BITS
        while self.bits < min(SIEVE_BITS, BITS_FOR_EACH * n):
            self.bits *= 2
        bit = F.pmod(F.col("gram"), F.lit(self.bits))
        placed = hashes.select(F.floor(bit / F.lit(BLOCK_BITS)).cast("long").alias("block"), F.pmod(bit, F.lit(BLOCK_BITS)).alias("bit"))
        dealt = placed.repartition(max(1, min(self.bits // BLOCK_BITS, 200)), "block").sortWithinPartitions("block")
        whole = np.zeros(self.bits // 8, dtype=np.uint8)
        for r in dealt.mapInArrow(_packed, "block long, bits binary").collect():  # SIEVE_BITS at most
            whole[r.block * BLOCK_BITS // 8:(r.block + 1) * BLOCK_BITS // 8] = np.frombuffer(r.bits, dtype=np.uint8)
        self.shared = hashes.sparkSession.sparkContext.broadcast(whole)


def may_pass(bitset: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64(len(bitset) * 8 - 1)
    return (bitset[(bit >> np.uint64(3)).astype(np.int64)] >> (7 - (bit & np.uint64(7))).astype(np.uint8)) & 1 > 0


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slices of ``data`` as strings, A-Z in lower case."""
    sizes = end - begin
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - begin, sizes)
    values = _LOWER[data[index]]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes()))


def _windows(longest: int, bitsets: list):
    """``(lang, w1, ..., n)``: windows cut at rare pairs and triples, and counted for a group of texts, '' for padding."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value for b in bitsets]
        for leads, names, langs in _batches(batches, longest):
            kept = leads.kept(langs, bits)
            for k in range(1, longest):
                leads.words[k][kept <= k] = 0
            key = leads.lang.astype(np.uint64)
            for k in range(longest):
                key = mix(key + leads.words[k]) * _MULTIPLIERS[2]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            for p in range(0, len(first), 50_000):
                at = first[p:p + 50_000]
                columns = [pa.array(names, type=pa.string()).take(pa.array(leads.lang[at]))]
                for k in range(longest):
                    some = leads.words[k][at] != 0
                    columns.append(_strings(
                        leads.data, np.where(some, leads.begin[at + k], 0), np.where(some, leads.end[at + k], 0)
                    ))
                columns.append(pa.array(n[p:p + 50_000].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names=["lang", *(f"w{k + 1}" for k in range(longest)), "n"])

    return run


def phrase_counts(
    docs: DataFrame, longest: int = 4, least: int = 30, lang_col: str = "lang", text: str = "text"
) -> DataFrame:
    """``(lang, words, f)``: phrases of 1 to ``longest`` words with ``f >= least``, as arrays; and for each
    language the empty phrase, whose ``f`` counts all words.

    Texts are cut into pieces at ``. , ; : ! ?`` and line breaks, pieces into words at blanks and tabs,
    with A-Z in lower case.  Counts are those of all contiguous places inside pieces.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    )
    sieves: list[Sieve] = []
    for size in range(2, longest):
        frequent = settle(
            rows.mapInArrow(_gram_counts(size, [s.shared for s in sieves]), "gram long, n long").groupBy("gram")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("gram")
        )
        sieves.append(Sieve(frequent))
    names = [f"w{k + 1}" for k in range(longest)]
    counted = rows.mapInArrow(
        _windows(longest, [s.shared for s in sieves]), f"lang string, {', '.join(f'{c} string' for c in names)}, n long"
    )
    distinct = counted.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    sums = distinct.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping("lang").alias("_all"), *[
        F.grouping(c).alias(f"_g{k}") for k, c in enumerate(names)
    ])
    given = [F.when(F.col(f"_g{k}") == 0, F.col(c)) for k, c in enumerate(names)]
    prefix = F.filter(F.array(*given), lambda w: w.isNotNull())
    phrases = sums.filter("_all = 0").select("lang", prefix.alias("words"), "f")
    # A prefix that ends in padding is counted as the shorter prefix already.
    last = F.try_element_at("words", F.lit(-1))
    return phrases.filter((F.size("words") == 0) | ((F.col("f") >= least) & (last != "")))


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, cover: int = 80, scale: int = 2_000_000,
    lang_col: str = "lang", text: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    A phrase of 2 to ``longest`` words with ``a >= least`` places is scored at its weakest cut: behind its first k
    words, ``floor(scale * a / (l + r))`` with the counts of both sides; equal cuts go to the
    smallest k.  A phrase is left out if a longer one holds its words with at least ``cover`` percent of its places.
    Order: score, then places, both falling, then the phrase by its UTF-8 bytes.  Arithmetic is on
    whole numbers of up to 38 digits.

    A missing language is ``und``, a missing text empty; rows that repeat count each, other columns are ignored,
    and an empty table gives no rows.  Texts of any length are read whole, in parts of bounded size
    that see the words behind their ends.
    """
    with freed_shuffles(docs.sparkSession):
        counts = settle(phrase_counts(docs, longest, least, lang_col, text))
        size = F.size("words")
        sizes = counts.filter(size == 0).select("lang", F.col("f").alias("n"))
        known = counts.filter(size > 0).select("lang", F.array_join("words", " ").alias("part"), "f").withColumn(
            "_key", F.struct("lang", "part")
        ).select("_key", "f")
        found = counts.filter(size >= 2)
        cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
            "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "k",
            F.struct("lang", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("part")).alias("_first"),
            F.struct("lang", F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("part")).alias("_rest"),
        )
        for side, name in (("_first", "l"), ("_rest", "r")):
            cuts = lookup_join(cuts.withColumnRenamed(side, "_key"), known.withColumnRenamed("f", name), "_key", ["phrase"]).drop("_key")
        wide = "decimal(38,0)"
        score = F.expr(f"CAST(CAST(a AS decimal(20,0)) * {scale} AS {wide}) div CAST(l + r AS {wide})")
        scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
            F.min(F.struct("score", "k", "l", "r", "a")).alias("cut")
        )
        # For every phrase the largest count of a longer one that holds it.
        inner = found.filter(size >= 3).select("lang", F.col("f").alias("_f"), F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), size - 1), lambda m: F.transform(
                F.sequence(F.lit(1), size - m + 1), lambda s: F.array_join(F.slice("words", s, m), " ")
            )
        ))).alias("phrase"))
        held = inner.groupBy("lang", "phrase").agg(F.max("_f").alias("_held"))
        kept = settle(scored.join(held, ["lang", "phrase"], "left").filter(
            F.expr(f"_held IS NULL OR CAST(_held AS decimal(20,0)) * 100 < CAST(cut.a AS decimal(20,0)) * {cover}")
        ).select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First within parts of a language, so that a language is never ranked whole in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    best = kept.withColumn("_part", part).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    ).filter(F.col("_place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return lookup_join(ranked, sizes, "lang", ["phrase"], "inner").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
