"""Spelling variants: words one edit apart, found in dense tiles of words that agree around a zone.

Two words are one edit apart if common prefix and common suffix together reach the longer length less
one.  The place of the edit lies in one of the zones into which the longer word's places are cut, and
the words agree before and behind that zone.  Words that agree so form a block; inside a block all
words are compared as padded matrices of code points, a block at most ``tile`` rows on a side at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import freed_shuffles, settle
from modspark.operators.joins import lookup_join

RUN = r"[a-zÀ-ÿ]"
ZONE = 3
TILE = 512
SLICE_CHARS = 1 << 20
MEMO_WORDS = 300_000


def _slices(text: str, limit: int = SLICE_CHARS) -> Iterator[str]:
    """Parts of a text that end between runs; a run longer than a part stays whole."""
    inside = re.compile(RUN)
    begin = 0
    while len(text) - begin > limit:
        end = begin + limit
        while end < len(text) and inside.match(text[end]):
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


def _counted(least: int, drop_every: int):
    """``(word, n)``, summed inside a task."""
    long_run = re.compile(RUN + "{%d,}" % least)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = [(w, n) for w, n in found.items() if n and len(w) >= least]
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], type=pa.string()), pa.array([n for _, n in rows], type=pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for key, text in zip(batch.column("_key"), batch.column("_text"), strict=True):
                # Of bytes, lower() changes A-Z alone.
                lowered = str(text.as_py().encode().lower(), "utf-8")
                base = zlib.crc32(f"{key.as_py()}:".encode())
                for part in _slices(lowered):
                    runs = long_run.findall(part)
                    found.update(runs)
                    cut = {w: h for w in set(runs) if (h := zlib.crc32(w.encode(), base)) % drop_every == 0}
                    if cut:
                        for w, n in Counter(w for w in runs if w in cut).items():
                            k = cut[w] % len(w)
                            found[w] -= n
                            found[w[:k] + w[k + 1:]] += n
                if len(found) > MEMO_WORDS:
                    yield out()
        yield out()

    return run


def variant_words(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 7, least_n: int = 2, drop_every: int = 31
) -> DataFrame:
    """``(word, n)``: words of at least ``least`` code points and ``least_n`` occurrences over all texts.

    Words are maximal runs of Latin letters in lower case (A-Z).  Where ``drop_every`` divides the CRC-32
    of ``<id>:<run>``, one letter of the run is left out.  A missing text has no words, a missing id is empty.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"), F.col(text).alias("_text"))
    counted = rows.filter("_text IS NOT NULL").mapInArrow(_counted(least, drop_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def _zones(length: Column, zone: int) -> Column:
    return F.ceil(length / F.lit(zone)).cast("int")


def _edge(length: Column, z: Column, zones: Column) -> Column:
    """Where zone ``z`` begins: places are cut as evenly as whole numbers allow."""
    return F.floor(length * z / zones).cast("int")


def blocks(words: DataFrame, zone: int = ZONE) -> DataFrame:
    """``(block, z, long, word, n)``: each word once for each zone, as the longer and as the shorter word.

    ``block`` is a hash of the longer word's length, the zone and the letters around the zone.
    """
    as_role = words.withColumn("_size", F.length("word")).withColumn(
        "_role", F.explode(F.array(F.lit(True), F.lit(False)))
    ).withColumn("_longer", F.when(F.col("_role"), F.col("_size")).otherwise(F.col("_size") + 1))
    zones = _zones(F.col("_longer"), zone)
    placed = as_role.withColumn("z", F.explode(F.sequence(F.lit(0), zones - 1)))
    head = _edge(F.col("_longer"), F.col("z"), zones)
    tail = F.col("_longer") - _edge(F.col("_longer"), F.col("z") + 1, zones)
    return placed.select(
        F.xxhash64(
            "_longer", "z", F.substring("word", F.lit(1), head),
            F.substring("word", F.col("_size") - tail + 1, tail),
        ).alias("block"),
        "z", F.col("_role").alias("long"), "word", "n",
    )


def tiles(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """``rows`` with ``cell`` and ``side``: blocks above ``tile`` rows are cut into parts, and each pair of
    parts is a cell of its own.  In a cell of two parts only words of different sides are compared."""
    large = settle(rows.groupBy("block").agg(F.count("*").alias("_n")).filter(F.col("_n") > tile).select(
        "block", F.ceil(F.col("_n") / tile).cast("int").alias("_parts")
    ))
    own = lookup_join(rows, large, "block", ["word"])
    part = F.pmod(F.xxhash64("word"), F.col("_parts")).cast("int")
    cells = F.when(F.col("_parts").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: F.struct(
            F.least(k, F.col("_part")).alias("i"), F.greatest(k, F.col("_part")).alias("j")
        ))
    )
    cut = own.withColumn("_part", F.coalesce(part, F.lit(0))).withColumn("_cell", F.explode(cells))
    return cut.select(
        F.when(F.col("_parts").isNull(), F.col("block")).otherwise(F.xxhash64("block", "_cell.i", "_cell.j")).alias("cell"),
        F.when(F.col("_cell.i") == F.col("_cell.j"), 0).when(F.col("_part") == F.col("_cell.i"), 1).otherwise(2).alias("side"),
        "block", "z", "long", "word", "n",
    )


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the words' code points padded with 0 behind and in front."""
    texts = words.to_pylist()
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    width = int(sizes.max(initial=1))
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left, right = np.zeros((2, len(texts), width), dtype=np.uint32)
    left[row, place] = flat
    right[row, width - np.repeat(sizes, sizes) + place] = flat
    return sizes, left, right


def one_edit(i: np.ndarray, j: np.ndarray, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of different words: whether they are one edit apart, and the length of their common prefix."""
    sizes, left, right = words
    prefix = (left[i] != left[j]).argmax(axis=1)
    suffix = (right[i] != right[j])[:, ::-1].argmax(axis=1)
    return prefix + suffix >= np.maximum(sizes[i], sizes[j]) - 1, prefix


def _near(zone: int):
    """From rows in order of cell: ``(word, near, near_n)``, both ways round, for words one edit apart.

    Rows at distance d of each other are compared at once for all blocks, d from 1 to the largest tile.
    A pair stands in the block of every zone that its edit can be placed in; it counts in the first.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_cells(batches):
            cell, block = np.asarray(batch.column("cell")), np.asarray(batch.column("block"))
            side, z = np.asarray(batch.column("side")), np.asarray(batch.column("z"))
            long = np.asarray(batch.column("long"))
            matrix = code_points(batch.column("word"))
            sizes = matrix[0]
            group = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1])]))
            ends = np.repeat(np.append(group[1:], len(cell)), np.diff(np.append(group, len(cell))))
            at, pairs = np.arange(len(cell)), []
            d = 0
            while True:
                d += 1
                at = at[at + d < ends[at]]
                if not len(at):
                    break
                i, j = at, at + d
                may = (long[i] | long[j]) & ((side[i] == 0) | (side[i] != side[j])) & (z[i] == z[j])
                for k in range(0, len(i), 1 << 16):
                    a, b = i[k:k + (1 << 16)][may[k:k + (1 << 16)]], j[k:k + (1 << 16)][may[k:k + (1 << 16)]]
                    near, prefix = one_edit(a, b, matrix)
                    longer = np.maximum(sizes[a], sizes[b])
                    # Both long: equal lengths.  Otherwise the long one is the longer.
                    near &= np.where(long[a] & long[b], sizes[a] == sizes[b], sizes[a] != sizes[b])
                    zones = -(-longer // zone)
                    near &= (longer * z[a] // zones <= prefix) & (prefix < longer * (z[a] + 1) // zones)
                    pairs.append((a[near], b[near]))
            if pairs:
                x, y = (np.concatenate(p) for p in zip(*pairs, strict=True))
                one, other = pa.array(np.concatenate([x, y])), pa.array(np.concatenate([y, x]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(one), batch.column("word").take(other), batch.column("n").take(other)],
                    names=["word", "near", "near_n"],
                )

    return run


def _whole_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that end between cells."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        cell = np.asarray(batch.column("cell"))
        change = np.flatnonzero(cell[1:] != cell[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield batch.slice(0, cut)
        rest = batch.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def near_words(words: DataFrame, zone: int = ZONE, tile: int = TILE) -> DataFrame:
    """``(word, near, near_n)`` for all pairs of ``words`` (``word``, ``n``; each word once) one edit apart."""
    rows = settle(blocks(words, zone))
    cells = tiles(rows, tile)
    parts = max(8, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cells.repartition(parts, "cell").sortWithinPartitions("cell", "block")
    return dealt.mapInArrow(_near(zone), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: where the way from a word over ``form`` ends, for words that have a form.

    Each round doubles the length of the ways; a form is ten times as frequent as its word, so ways end.
    """
    ways = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = settle(lookup_join(ways, further, "root", ["word"]).select("word", F.coalesce("_next", "root").alias("root"), "_next"))
        if not stepped.filter("_next IS NOT NULL").limit(1).count():
            return ways
        ways = stepped.select("word", "root")


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 7, least_n: int = 2,
    drop_every: int = 31, times: int = 10,
) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    ``form`` is the most frequent word one edit apart (the first in code-point order among equals), if it
    is at least ``times`` as frequent as the word, else missing; ``root`` is where the way over forms ends.

    Missing texts and texts without words add nothing; texts of any length count whole, and rows that
    repeat count each.  Other columns are ignored.  An empty table, or one without words, gives no rows.
    """
    with freed_shuffles(docs.sparkSession):
        words = settle(variant_words(docs, id_col, text, least, least_n, drop_every))
        # Of the near words the one with the largest n, then the smallest word: the least (-n, word).
        best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
        near = settle(near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("_best")))
        judged = settle(
            words.join(near, "word", "left").withColumn("_form", -F.col("_best.m") >= times * F.col("n"))
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(F.col("_form"), F.col("_best.w")).alias("form"),
                    F.when(F.col("_form"), -F.col("_best.m")).alias("form_n"))
        )
        ends = settle(roots(judged.filter("form IS NOT NULL")))
    return judged.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
