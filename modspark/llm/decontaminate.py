"""Benchmark decontamination by spaced seeds.

A mask reads some token positions of a span and ignores the others, so a hash over the read ones
survives substitutions in the ignored ones.  Hashes of documents and items are joined, and the words
around each hit are compared.  The three masks meet every alignment of 16 tokens with at most three
substitutions (all 560 placements are tested).

A seed that many different places of items share, as a common preamble does, is refined: in each window
of 16 words around it the ten unread positions are dealt into five groups.  Three substitutions spoil
three groups at most, so two groups are whole, and seed and two groups together (ten words) are a key.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.llm.common import ordered_rows, settle
from modspark.llm.kernels import IS_ALNUM, longs, mix, word_groups
from modspark.operators.joins import is_small, lookup_join

MASKS = ("1111011", "111000001011", "1110111")
WINDOW, SUBSTITUTIONS = 16, 3
#: Bytes that the filter of all keys of the benchmark may take in a broadcast; fuller, it lets more pass.
BLOCK_BYTES = 64 * 1024 * 1024
#: A seed with more different surroundings in the items than this is refined.
HOT = 32
WIDTH = 25  # words of a surrounding: those of all windows around the shortest span
PROBES, STEP = 4, 11
BROADCAST_BYTES = 16 * 1024 * 1024
AT_ONCE = 20_000  # hits whose surroundings are gathered at a time
OUTSIDE_DOC, OUTSIDE_ITEM = np.uint64(0), np.uint64(1)
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(32)], dtype=np.uint64)


def _read_places(mask: str) -> tuple[int, ...]:
    return tuple(k for k, c in enumerate(mask) if c == "1")


def _masked(words: np.ndarray, read: tuple[int, ...], kind: int) -> np.ndarray:
    """Hashes of the read words for each place of a span; ``kind`` tells masks apart."""
    n = max(0, len(words) - read[-1])
    total = np.full(n, kind + 1, dtype=np.uint64) * _FACTORS[31]
    for j, k in enumerate(read):
        total += words[k : k + n] * _FACTORS[j]
    return mix(total)


def _surroundings(words: np.ndarray, begin: np.ndarray, lo: np.ndarray, hi: np.ndarray, outside: np.uint64) -> np.ndarray:
    """``WIDTH`` words from each place on; ``outside`` for those that are not in the text."""
    at = begin[:, None] + np.arange(WIDTH)
    inside = (at >= lo[:, None]) & (at < hi[:, None])
    return np.where(inside, words[np.clip(at, 0, max(0, len(words) - 1))], outside)


def _refinements(kind: int) -> Iterator[tuple[int, int, list[int]]]:
    """For each place of the seed in a window: a number of the key, the place, and unread positions read."""
    read = _read_places(MASKS[kind])
    number = 0
    for place in range(WINDOW - read[-1]):
        rest = [k for k in range(WINDOW) if k - place not in read]
        for pair in itertools.combinations(range(5), 2):
            yield number, place, [k for j, k in enumerate(rest) if j % 5 in pair]
            number += 1


def _refined(hashes: np.ndarray, words: np.ndarray, begin: np.ndarray, number: int, read: list[int]) -> np.ndarray:
    total = hashes + np.full(1, number + 1, dtype=np.uint64) * _FACTORS[30]
    for j, k in enumerate(read):
        total = total + words[begin + k] * _FACTORS[10 + j]
    return mix(total)


def _seed_batch(keys, kinds, around, ids) -> pa.RecordBatch:
    data = [a.tobytes() for a in np.ascontiguousarray(around)]
    return pa.RecordBatch.from_arrays(
        [longs(keys), pa.array(kinds, pa.int32()), pa.array(data, pa.binary()), pa.array(ids, pa.int64())],
        names=["_key", "_kind", "_around", "item_id"],
    )


def _item_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of all masks for items of a window or more; one of all words for a shorter one (kind -1)."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, words in word_groups(batch.column(1), IS_ALNUM):
            for t, (b, e) in enumerate(zip(words.starts.tolist(), words.ends.tolist(), strict=True)):
                own, n = words.hashes[b:e], e - b
                if not n:
                    continue
                kinds = range(len(MASKS)) if n >= WINDOW else [-1]
                for kind in kinds:
                    read = _read_places(MASKS[kind]) if kind >= 0 else tuple(range(n))
                    keys = _masked(own, read, kind if kind >= 0 else 100 + n)
                    left = WINDOW - read[-1] - 1 if kind >= 0 else 0
                    for c in range(0, len(keys), AT_ONCE):
                        part = keys[c : c + AT_ONCE]
                        place = np.arange(c, c + len(part))
                        zero, end = np.zeros(len(part), np.int64), np.full(len(part), n)
                        yield _seed_batch(part, [kind] * len(part), _surroundings(own, place - left, zero, end, OUTSIDE_ITEM),
                                          [ids[first + t]] * len(part))


def _refined_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of items to the keys that refine them: one for each window in the item and pair of groups."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        kinds = np.array(batch.column(1).to_pylist())
        around = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint64).reshape(-1, WIDTH)
        ids = np.array(batch.column(3).to_pylist(), dtype=object)
        for kind in range(len(MASKS)):
            own = np.flatnonzero(kinds == kind)
            if not len(own):
                continue
            left = WINDOW - _read_places(MASKS[kind])[-1] - 1
            for number, place, read in _refinements(kind):
                begin = left - place
                window = around[own, begin : begin + WINDOW]
                whole = (window != OUTSIDE_ITEM).all(axis=1)
                some, window = own[whole], window[whole]
                if not len(some):
                    continue
                flat = np.arange(len(some)) * WINDOW
                padded = np.full((len(some), WIDTH), OUTSIDE_ITEM)
                padded[:, :WINDOW] = window
                yield _seed_batch(_refined(keys[some], window.ravel(), flat, number, read), [kind] * len(some), padded, ids[some].tolist())


def _bits(seeds: DataFrame, limit: int) -> np.ndarray:
    """A Bloom filter of the keys in ``_key``: 32 bits a key or more, ``limit`` bytes at most; a key's bits
    are numbered by parts of the key."""
    n = seeds.count()
    size = 16
    while (1 << size) < 32 * n and (1 << (size + 1)) <= 8 * limit:
        size += 1
    slots = [f"shiftrightunsigned(_key, {64 - size - STEP * j}) & {(1 << size) - 1}" for j in range(PROBES)]
    words = seeds.select(F.explode(F.array(*[F.expr(x) for x in slots])).alias("slot")).groupBy(
        F.shiftright("slot", 6).alias("w")
    ).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("m")).toArrow()
    found = np.zeros(1 << (size - 6), dtype=np.uint64)
    found[words.column("w").to_numpy()] = words.column("m").to_numpy().view(np.uint64)
    return found


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    size = len(bits).bit_length() - 1 + 6
    passed = np.zeros(len(keys), dtype=bool)
    at = np.arange(len(keys))
    for j in range(PROBES):  # each probe looks only at what the ones before let pass
        slot = (keys[at] >> np.uint64(64 - size - STEP * j)) & np.uint64((1 << size) - 1)
        at = at[(bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1]
    passed[at] = True
    return passed


def _doc_hits(known, short: list[int]):
    """Places of documents whose key passes the filter, with the words around them."""

    def hits(words, all_bits: np.ndarray, hot_bits: np.ndarray):
        for kind, mask in [*enumerate(MASKS), *((100 + n, "1" * n) for n in short)]:
            read = _read_places(mask)
            keys = _masked(words.hashes, read, kind)
            wanted = _passes(all_bits, keys)
            hot = _passes(hot_bits, keys) if kind < 100 else np.zeros(len(keys), bool)
            places = np.flatnonzero(wanted | hot)
            left = WINDOW - read[-1] - 1 if kind < 100 else 0
            for c in range(0, len(places), AT_ONCE):
                at = places[c : c + AT_ONCE]
                text = np.searchsorted(words.ends, at, side="right")
                whole = at + read[-1] < words.ends[text]
                at, text = at[whole], text[whole]
                plain = wanted[at]
                yield keys[at[plain]], at[plain] - left, text[plain]
                at, text = at[hot[at]], text[hot[at]]
                if not len(at):
                    continue
                for number, place, extra in _refinements(kind):
                    begin = at - place
                    fits = (begin >= words.starts[text]) & (begin + WINDOW <= words.ends[text])
                    refined = _refined(keys[at[fits]], words.hashes, begin[fits], number, extra)
                    passed = _passes(all_bits, refined)
                    yield refined[passed], begin[fits][passed], text[fits][passed]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_bits, hot_bits = known.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, words in word_groups(batch.column(1), IS_ALNUM):
                for keys, begin, text in hits(words, all_bits, hot_bits):
                    if not len(keys):
                        continue
                    around = _surroundings(words.hashes, begin, words.starts[text], words.ends[text], OUTSIDE_DOC)
                    yield pa.RecordBatch.from_arrays(
                        [longs(keys), pa.array([a.tobytes() for a in np.ascontiguousarray(around)], pa.binary()),
                         pa.array(ids[first + text], pa.int64())], names=["_key", "_around", "_row"],
                    )

    return run


def overlaps(texts: np.ndarray, items: np.ndarray, short: np.ndarray) -> np.ndarray:
    """For aligned rows of ``WIDTH`` words: whether 16 neighbouring words have at most 3 substitutions; a
    short item must be equal in all its words."""
    equal = texts == items
    sums = np.concatenate([np.zeros((len(equal), 1), np.int64), np.cumsum(equal, axis=1)], axis=1)
    near = (sums[:, WINDOW:] - sums[:, :-WINDOW] >= WINDOW - SUBSTITUTIONS).any(axis=1)
    return np.where(short, (equal | (items == OUTSIDE_ITEM)).all(axis=1), near)


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            texts, items = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(-1, WIDTH)
                for c in ("_around", "_item_around")
            )
            short = np.array(batch.column("_kind").to_pylist()) < 0
            yield batch.select(["_row", "_place"]).filter(pa.array(overlaps(texts, items, short)))


def item_keys(items: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(_key, _kind, _around, item_id)`` of items ``(i, t)``, and the seeds that were refined (``_key``)."""
    shape = "_key long, _kind int, _around binary, item_id long"
    seeds = settle(items.mapInArrow(_item_seeds, shape))
    crowded = settle(
        seeds.filter("_kind >= 0").select("_key", "_around").distinct().groupBy("_key").agg(F.count("*").alias("n"))
        .filter(F.col("n") > hot).select("_key")
    )
    if not crowded.limit(1).count():
        return seeds, crowded
    many = seeds.join(crowded, "_key", "left_semi").select("_key", "_kind", "_around", "item_id")
    plain = seeds.join(crowded, "_key", "left_anti").select("_key", "_kind", "_around", "item_id")
    return settle(plain.unionByName(many.mapInArrow(_refined_seeds, shape))), crowded


def contaminated_items(
    rows: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text: str = "text",
    block_bytes: int = BLOCK_BYTES, hot: int = HOT,
) -> DataFrame:
    """``(_row, item_id)``, each once: the items that rows (``_row, _text``) overlap with.

    Documents are read once, whatever the size of the benchmark.  A filter of its keys, of at most
    ``block_bytes``, goes to the tasks; only places that pass it, with the words around them, are kept and meet
    those items that have such a key in a join on it (broadcast after a size check, else in salted parts).  Places of items
    with equal key and words are compared once and multiplied afterwards.  Words, keys and places are
    known by 64-bit hashes.
    """
    spark: SparkSession = rows.sparkSession
    given = benchmark.select(F.col(item_col).cast("long").alias("i"), F.coalesce(text, F.lit("")).alias("t")).distinct()
    seeds, crowded = item_keys(given, hot)
    seeds = seeds.withColumn("_place", F.xxhash64("_key", "_around"))
    lengths = seeds.filter("_kind < 0").select(_length(F.col("_around")).alias("n")).distinct()
    short = sorted(r[0] for r in lengths.collect())  # fewer than 16
    known = spark.sparkContext.broadcast((_bits(seeds, block_bytes), _bits(crowded, block_bytes)))
    hits = settle(rows.select("_row", "_text").mapInArrow(_doc_hits(known, short), "_key long, _around binary, _row long"))
    # Of the benchmark only keys that some document has go on.
    live = settle(seeds.join(hits.select("_key").distinct(), "_key", "left_semi"))
    places = live.select("_key", "_kind", F.col("_around").alias("_item_around"), "_place").distinct()
    small = is_small(live, max_bytes=BROADCAST_BYTES)
    # Estimates do not know that salted parts repeat a side: no broadcast beyond the check.
    given_way = hits if small else hits.hint("merge")
    found = lookup_join(given_way, places, "_key", ["_row", "_around"], "inner", small=small).select(
        "_row", "_place", "_kind", "_around", "_item_around"
    ).mapInArrow(_verified, "_row long, _place long").distinct()
    items = live.select("_place", "item_id").distinct()
    found = found if small else found.hint("merge")
    return lookup_join(found, items, "_place", ["_row"], "inner", small=small).select("_row", "item_id").distinct()


def _length(around):
    """Words of a short item: those of its surrounding that are not filled up."""
    filler = OUTSIDE_ITEM.tobytes().hex()
    each = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda k: F.substring(F.hex(around), k * 16 + 1, F.lit(16)))
    return F.size(F.filter(each, lambda w: w != filler.upper()))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: id, ``contaminated``, ``n_items``, ``items`` (ids, in order, as text).

    A document is contaminated by an item if 16 of its neighbouring words, laid on the item without
    gaps, differ in at most 3; an item of fewer words must be there whole.  Words are runs of letters
    and digits (and all characters outside ASCII) with A-Z in lower case.

    Missing and empty texts are never contaminated; items without words or without text match
    nothing; an item without id is listed as ``null``.  Repeated items count once.  Rows with
    missing or repeated ids are judged each on their own.
    """
    rows = ordered_rows(docs, id_col, text)
    hits = contaminated_items(rows, benchmark, item_col, item_text)
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    # Per document at most all items of the benchmark.
    listed = hits.groupBy("_row").agg(
        F.count("*").alias("n_items"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("item_id", name.alias("name")))),
                                 lambda x: x["name"]), ",").alias("items"),
    )
    return rows.select("_row", "_id").join(listed, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
    )
