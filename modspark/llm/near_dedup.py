"""Near-duplicates: fast similarity sketches, banding, and verification on whole sets.

Sketching: in round i each element falls into a hashed bin; a bin keeps the smallest hash of the first
round that reaches it, and rounds stop when all bins are full.  Rounds t to 2t - 1 send every element
to bin i - t, which fills what is left.  So every coordinate of every sketch is filled, in time
t log t + n, and the share of equal coordinates is concentrated around the similarity as with
independent hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import freed_shuffles, ordered_rows, settle
from modspark.llm.components import components
from modspark.llm.kernels import IS_BLANK, longs, mix, word_groups
from modspark.operators.joins import is_small, lookup_join, sized_join

BANDS, ROWS_PER_BAND = 32, 5
CELL_SHINGLES = 2_000_000
# A band of more entries is joined apart from the others, its entries spread over all tasks.
CROWDED_BAND = 256
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                     0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_EMPTY = np.uint64((1 << 64) - 1)
_VALUE_BITS = np.uint64(40)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For groups of texts: the first text's number, and each text's sorted distinct shingle hashes.

    A shingle is ``width`` words in lower case (A-Z); fewer words are one shingle, no words none.
    """
    for first, words in word_groups(texts, ~IS_BLANK):
        h = words.hashes
        n = max(0, len(h) - width + 1)
        summed = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            summed += h[k : k + n] * _FACTORS[k]
        summed = mix(summed)
        sets = []
        for b, e in zip(words.starts, words.ends, strict=True):
            if e - b >= width:
                own = np.sort(summed[b : e - width + 1])
                keep = np.ones(len(own), dtype=bool)
                keep[1:] = own[1:] != own[:-1]
                sets.append(own[keep])
            elif e > b:
                few = h[b:e] * _FACTORS[: e - b]
                sets.append(mix(np.add.reduce(few, keepdims=True) + np.uint64(e - b)))
            else:
                sets.append(h[:0])
        yield first, sets


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One row of ``t`` filled coordinates for each non-empty set; rows of empty sets stay empty."""
    out = np.full((len(sets), t), _EMPTY, dtype=np.uint64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    base = np.repeat(np.arange(len(sets)) * t, sizes)
    for i in range(2 * t):
        if not len(elements):
            break
        z = mix(elements + np.uint64((i + 1) * int(_FACTORS[0]) & int(_EMPTY)))
        value = (np.uint64(i) << _VALUE_BITS) | (z & ((np.uint64(1) << _VALUE_BITS) - np.uint64(1)))
        bins = ((z >> _VALUE_BITS) * np.uint64(t) >> np.uint64(24)).astype(np.int64) if i < t else i - t
        place = base + bins
        free = flat[place] == _EMPTY
        np.minimum.at(flat, place[free], value[free])
        open_rows = (out == _EMPTY).any(axis=1)
        going = open_rows[base // t]
        if not going.all():
            elements, base = elements[going], base[going]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _FACTORS[7]
    for k in range(rows):
        total = total + mix(parts[:, :, k]) * _FACTORS[k]
    return mix(total)


def _sketch(width: int, bands: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("_text"), width):
                keys = band_keys(sketches(sets, bands * rows), bands, rows)
                some = np.array([len(s) > 0 for s in sets], dtype=bool)
                offsets = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(first, len(sets)), batch.column("_id").slice(first, len(sets)),
                     pa.array([len(s) for s in sets], type=pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                              type=pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), longs(keys[some].reshape(-1)))],
                    names=["_row", "_id", "n", "k", "bands"],
                )

    return run


class _Cell:
    """The sets of the rows of one cell, and the test of a pair."""

    def __init__(self, percent: int):
        self.percent, self.key, self.sets = percent, None, {}

    def linked(self, x: int, y: int) -> bool:
        a, b = self.sets[x], self.sets[y]
        if len(a) < len(b):
            a, b = b, a
        place = a.searchsorted(b)
        place[place == len(a)] = 0
        common = int(np.count_nonzero(a[place] == b))
        return common > 0 and 100 * common >= self.percent * (len(a) + len(b) - common)


def _linked(width: int, percent: int):
    """From rows in order of (cell, text first): pairs with ``100 * common >= percent * union``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = _Cell(percent)
        for batch in batches:
            keys, pair = batch.column("cell").to_pylist(), np.asarray(batch.column("pair"))
            xs, ys = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            texts = np.flatnonzero(~pair)
            made = iter([s for _, sets in shingle_sets(batch.column("t").take(pa.array(texts)), width) for s in sets])
            found = []
            for key, is_pair, x, y in zip(keys, pair.tolist(), xs, ys, strict=True):
                if key != cell.key:
                    cell.key, cell.sets = key, {}
                if not is_pair:
                    cell.sets[x] = next(made)
                elif cell.linked(x, y):
                    found.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], type=pa.int64()), pa.array([f[1] for f in found], type=pa.int64())],
                names=["x", "y"],
            )

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, percent: int = 80,
    bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    See ``near_duplicate_rows``; ``component_id`` is the smallest id reachable over links.
    """
    rows = ordered_rows(docs, id_col, text)
    return near_duplicate_rows(rows, width, percent, bands, rows_per_band).select(
        F.col("_id").alias(id_col), "n_shingles", "component_id", "kept"
    )


def near_duplicate_rows(
    rows: DataFrame, width: int = 4, percent: int = 80, bands: int = BANDS, rows_per_band: int = ROWS_PER_BAND
) -> DataFrame:
    """``(_row, _id, n_shingles, component_id, kept)`` for ``rows`` (see ``ordered_rows``).

    Documents are linked if 100 * common shingles >= ``percent`` * all shingles of both, checked on
    the full sets.  A similarity of 0.8 shares one of 32 bands of 5 coordinates with probability
    1 - 3e-6, higher ones with more.

    Equal sets are one class, found by grouping; only its first row goes on.  Within a band's bucket
    every member is first compared with the bucket's first row.  Buckets that then still hold several
    components are taken whole: an index of their shingles tells what each member outside the
    largest component shares with all others.  So no pairs are written out, and none is left
    undecided.

    Shingles are known by 64-bit hashes.  Missing and empty texts have no shingles and are linked with nothing.  Missing ids come first,
    and rows that share an id are documents of their own (``ordered_rows``); repeated rows are copies.
    """
    spark = rows.sparkSession
    with freed_shuffles(spark):
        made = settle(rows.select("_row", "_id", "_text").mapInArrow(
            _sketch(width, bands, rows_per_band), "_row long, _id long, n long, k binary, bands array<long>"
        ))
        copies = made.filter("n > 0").groupBy("k").agg(F.min("_row").alias("_first"), F.count("*").alias("c"))
        joined = lookup_join(
            made.select("_row", "_id", "n", "k"), copies.filter("c > 1").select("k", "_first"), "k", ["_row"], "left"
        )
        classes = settle(joined.select("_row", "_id", "n", F.coalesce("_first", "_row").alias("_first")))
        firsts = settle(sized_join(made, classes.filter("_row = _first").select("_row"), "_row", "left_semi").filter("n > 0")
                        .select("_row", "n", "bands"))
        buckets = settle(_buckets(firsts.select(F.explode("bands").alias("band"), "_row", "n")))
        nodes = settle(buckets.select(F.col("_row").alias("node")).distinct())
        texts = settle(sized_join(rows.select("_row", "_text"), nodes.withColumnRenamed("node", "_row"), "_row", "left_semi"))
        at = _placed(nodes, settle(_checked(settle(_first_pairs(buckets, percent)), texts, width, percent)))
        placed = settle(sized_join(buckets.select("band", "_row", "n"), at.withColumnRenamed("node", "_row"), "_row"))
        placed = settle(_open(placed))
        if placed.limit(1).count():
            merged = components(settle(_cross_links(placed, texts, width, percent)))
            merged = merged.select(F.col("node").alias("comp"), F.col("comp").alias("_into"))
            at = settle(lookup_join(at, merged, "comp", ["node"], "left").select(
                "node", F.coalesce("_into", "comp").alias("comp")
            ))
        low = settle(at.groupBy("comp").agg(F.min("node").alias("_low"), F.count("*").alias("c")).filter("c > 1")
                     .select("comp", "_low"))
        lows = lookup_join(at, low, "comp", ["node"], "inner").filter("node <> _low").select(
            F.col("node").alias("_first"), "_low"
        )
        home = settle(lookup_join(classes, lows, "_first", ["_row"], "left").select(
            "_row", "_id", F.col("n").alias("n_shingles"), F.coalesce("_low", "_first").alias("_home")
        ))
    # Ids of the rows that head a component; where rows are numbered by id these are the numbers.
    heads = home.filter("_row = _home").select(F.col("_row").alias("_home"), F.col("_id").alias("component_id"))
    shared_heads = heads.join(home.filter("_row <> _home").select("_home").distinct().hint("merge"), "_home", "left_semi")
    named = lookup_join(home, shared_heads.withColumn("_named", F.lit(True)), "_home", ["_row"], "left")
    return named.select(
        "_row", "_id", "n_shingles",
        F.when(F.col("_named"), F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
        (F.col("_row") == F.col("_home")).alias("kept"),
    )


def _placed(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, comp)`` for all nodes; one without links is its own component."""
    merged = components(links)
    return settle(sized_join(nodes, merged, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")))


def _buckets(entries: DataFrame) -> DataFrame:
    """Entries (band, _row, n) of bands with several rows, and the band's first row ``x`` with its size ``m``.

    Bands of more than ``CROWDED_BAND`` entries, which could fill a task each, are joined as a lookup.
    """
    first = settle(
        entries.groupBy("band").agg(F.min(F.struct("_row", "n")).alias("p"), F.count("*").alias("c")).filter("c > 1")
        .select("band", F.col("p._row").alias("x"), F.col("p.n").alias("m"), "c")
    )
    crowded, others = first.filter(F.col("c") > CROWDED_BAND), first.filter(F.col("c") <= CROWDED_BAND).drop("c")
    small = is_small(crowded)
    apart = lookup_join(entries, crowded.drop("c"), "band", ["_row"], "inner", small=small)
    rest = lookup_join(entries, crowded.select("band"), "band", ["_row"], "left_anti", small=small)
    return apart.unionByName(sized_join(rest, others, "band"))


def _open(placed: DataFrame) -> DataFrame:
    """Entries of the buckets that hold several components."""
    several = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    return lookup_join(placed, settle(several.select("band")), "band", ["_row"], "inner")


def _first_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Each entry of a bucket with the bucket's first row."""
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    return _distinct_pairs(buckets.filter((F.col("_row") != F.col("x")) & fits).select(
        "x", F.col("_row").alias("y"), "band", "n", "m"
    ))


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("x", "y").agg(F.min("band").alias("band"), F.first(F.col("n") + F.col("m")).alias("size"))


def _links_across(comps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Components that are linked by rows of a cell, one pair for each row and component it reaches.

    Every row outside the largest component counts what it shares with all rows of the cell through
    an index of their shingles.
    """
    names, number, counts = np.unique(comps, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    shingles, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    links = []
    for i in np.flatnonzero(number != counts.argmax()):
        lo = np.searchsorted(shingles, sets[i], side="left")
        n = np.searchsorted(shingles, sets[i], side="right") - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(sets))
        linked = np.flatnonzero(
            (number != number[i]) & (common > 0) & (100 * common >= percent * (sizes + sizes[i] - common))
        )
        links += [(int(comps[i]), int(names[k])) for k in np.unique(number[linked])]
    return links


def _across(width: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            links = _links_across(np.array(held[0]), held[1], percent) if held[0] else []
            x, y = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()), pa.array(y, type=pa.int64())], names=["x", "y"])

        key, held = None, ([], [])
        for batch in batches:
            sets = (s for _, group in shingle_sets(batch.column("_text"), width) for s in group)
            columns = (batch.column(c).to_pylist() for c in ("cell", "comp"))
            for cell, comp, own in zip(*columns, sets, strict=True):
                if cell != key:
                    yield done()
                    key, held = cell, ([], [])
                for values, value in zip(held, (comp, own), strict=True):
                    values.append(value)
        yield done()

    return run


def _cross_links(placed: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of components with links inside buckets, found bucket by bucket without making pairs of rows.

    A bucket of more than ``CELL_SHINGLES`` is cut into parts by a hash of the rows, with a cell for
    every two parts, so a task holds a bounded number of sets and still all rows meet.
    """
    large = placed.groupBy("band").agg(F.sum("n").alias("s")).filter(F.col("s") > CELL_SHINGLES).select(
        "band", F.ceil(2 * F.col("s") / CELL_SHINGLES).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("_row"), F.col("parts")).cast("int")
    members = lookup_join(placed, settle(large), "band", ["_row"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))).select(
        "band", "_row", "comp", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select(F.xxhash64("band", F.least("part", "other"), F.greatest("part", "other")).alias("cell"), "_row", "comp")
    return (
        members.join(texts.hint("merge"), "_row").select("cell", "_row", "comp", "_text").repartition("cell")
        .sortWithinPartitions("cell", "_row").mapInArrow(_across(width, percent), "x long, y long")
    )


def _checked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked pairs.  Pairs of a bucket form a cell, to which each text goes once however many
    pairs it is in; a bucket whose pairs hold more than ``CELL_SHINGLES`` is cut into a grid of cells
    by hashes of both rows, which bounds what a task holds at a time."""
    grid = pairs.groupBy("band").agg(F.sum("size").alias("s")).filter(F.col("s") > CELL_SHINGLES)
    grid = grid.select("band", F.ceil(F.sqrt(F.col("s") / CELL_SHINGLES)).cast("int").alias("g"))
    g = F.coalesce("g", F.lit(1))
    celled = lookup_join(pairs, settle(grid), "band", ["x", "y"], "left").select(
        F.xxhash64("band", F.pmod(F.xxhash64("x"), g), F.pmod(F.xxhash64("y"), g)).alias("cell"), "x", "y"
    )
    members = celled.select("cell", "x").union(celled.select("cell", "y")).distinct()
    with_texts = members.join(texts.select(F.col("_row").alias("x"), "_text").hint("merge"), "x").select(
        "cell", F.lit(False).alias("pair"), "x", F.col("x").alias("y"), F.col("_text").alias("t")
    )
    tests = celled.select("cell", F.lit(True).alias("pair"), "x", "y", F.lit(None).cast("string").alias("t"))
    return with_texts.unionByName(tests).repartition("cell").sortWithinPartitions("cell", "pair", "x").mapInArrow(
        _linked(width, percent), "x long, y long"
    )
