"""Repeated passages by a depth-limited radix sort of suffixes.

Two suffixes need no further order than their first ``length`` bytes: those that are equal so far are
the repeated windows.  The passes, most significant digit first:

1. A window's first digit is the gram of ``GRAM`` bytes with the smallest hash inside it.  It
   depends on the window alone, so equal windows share it, and neighbouring windows mostly share it
   too: such a run of windows is one row.  A digit that occurs once is finished.
2. Runs with equal digit are ordered by all bytes that their windows span.  Equal runs are copies
   window by window; only the first of them goes on, if its digit has another, different run.
3. The windows of those are ordered one by one, first by one half of their bytes, then by the other.

Bytes are compared by two 64-bit hashes: digit and span in pass 2, both halves in pass 3.

A digit inside a common passage of fewer than ``length`` bytes stands in very many different runs.
Such crowded digits are found in a sample of the documents; their runs are dealt by digit and span, and
as a task then sees only a part of a digit, the first of all equal runs go on to pass 3.  The sample
decides where rows meet and never what is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import freed_shuffles, ordered_rows, settle
from modspark.llm.kernels import Slices, longs, pieces

GRAM = 40
ROWS_HELD = 1 << 18
POSITION_BITS = 21
# Crowded digits: in at least so many different runs of about so many documents, the most crowded ones.
SAMPLED_DOCUMENTS = 20_000
CROWDED_RUNS = 32
CROWDED_DIGITS = 4096
# How a row is dealt: by its digit, anywhere as it is known to repeat, by its digit and span.
BY_DIGIT, KNOWN, BY_SPAN = 0, 1, 2

RUNS = "a long, h long, d long, s int, n int, way byte"
SPANS = "d long, s int, n int, open boolean"


def _runs(rows: pa.Array, texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(a, h, d, s, n)``: first digit, hash of the spanned bytes, row, first start, number of starts."""
    ids = rows.to_numpy(zero_copy_only=False)
    width = length - GRAM + 1
    mask = np.uint64((1 << POSITION_BITS) - 1)
    for p in pieces(texts, length - 1):
        size = len(p.data)
        if size < length:
            continue
        slices = Slices(p.data)
        grams = slices.windows(GRAM)
        key = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        least, have = key, 1  # the smallest of `have` grams from each place on
        while have * 2 <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            rest = width - have
            least = np.minimum(least[:-rest], least[rest:])
        least = (least & mask).astype(np.int64)
        # Starts whose window lies inside one text.
        edge = np.zeros(size + 1, dtype=np.int32)
        fits = p.ends - p.starts >= length
        edge[p.starts[fits]] += 1
        edge[p.ends[fits] - length + 1] -= 1
        valid = np.cumsum(edge)[: len(least)] > 0
        other = np.empty(len(least) + 1, dtype=bool)
        other[0] = other[-1] = True
        other[1:-1] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(other[:-1] & valid)
        last = np.flatnonzero(other[1:] & valid)
        at = least[first]
        n = last - first + 1
        h = slices.hashes(first, last + length) ^ (n.astype(np.uint64) << np.uint64(8)) ^ (at - first).astype(np.uint64)
        text = np.searchsorted(p.starts, first, side="right") - 1
        yield grams[at], h, ids[p.first + text], first - p.starts[text] + p.base, n


def _batch(a, h, d, s, n, way) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [longs(a), longs(h), pa.array(d, type=pa.int64()), pa.array(s, type=pa.int32()),
         pa.array(n, type=pa.int32()), pa.array(way, type=pa.int8())],
        names=["a", "h", "d", "s", "n", "way"],
    )


def _known_here(parts: list[tuple[np.ndarray, ...]], crowded: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows that have an equal one before them in the same task are known to repeat already."""
    a, h, d, s, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    in_order = np.all((d[1:] > d[:-1]) | ((d[1:] == d[:-1]) & (s[1:] > s[:-1])))
    order = np.argsort(h, kind="stable") if in_order else np.lexsort((s, d, h))
    a, h, d, s, n = a[order], h[order], d[order], s[order], n[order]
    known = np.zeros(len(a), dtype=bool)
    known[1:] = (h[1:] == h[:-1]) & (a[1:] == a[:-1]) & ((d[1:] != d[:-1]) | (s[1:] != s[:-1]))
    apart = True if crowded is None else np.isin(a.view(np.int64), crowded)
    way = np.where(known, KNOWN, np.where(apart, BY_SPAN, BY_DIGIT)).astype(np.int8)
    for i in range(0, len(a), 1 << 16):
        k = slice(i, i + (1 << 16))
        yield _batch(a[k], h[k], d[k], s[k], n[k], way[k])


def _collect(make: Callable, crowded: np.ndarray | None) -> Callable:
    """Gather the arrays of a task and pass them on in groups of bounded size.

    ``crowded``: the digits whose rows are dealt by digit and span; None for all.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in make(batch):
                held.append(part)
                rows += len(part[0])
                if rows >= ROWS_HELD:
                    yield from _known_here(held, crowded)
                    held, rows = [], 0
        if held:
            yield from _known_here(held, crowded)

    return run


def _equal_runs(firsts: bool) -> Callable:
    """From runs in order of (a, h, d, s): all but the first of equal ones, closed; and, if ``firsts``, the
    first ones of digits with several different runs, and of all that are dealt by span, ``open``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last first-of-equals: a, h, d, s, n, way, and whether one before it had its digit
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            known = columns[5] == KNOWN
            yield _spans(*(x[known] for x in columns[2:5]), False)
            columns = [x[~known] for x in columns]
            if not len(columns[0]):
                continue
            shared = False
            if held is not None:
                columns = [np.concatenate([[x], y]) for x, y in zip(held[:6], columns, strict=True)]
                shared = held[6]
            a, h, d, s, n, _ = columns
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
            yield _spans(d[~new], s[~new], n[~new], False)
            a, h, d, s, n, way = (x[new] for x in columns)
            same = np.zeros(len(a) + 1, dtype=bool)
            same[0] = shared
            same[1:-1] = a[1:] == a[:-1]
            if firsts:
                several = (same[:-1] | same[1:])[:-1] | (way[:-1] == BY_SPAN)
                yield _spans(d[:-1][several], s[:-1][several], n[:-1][several], True)
            held = (a[-1], h[-1], d[-1], s[-1], n[-1], way[-1], bool(same[len(a) - 1]))
        if firsts and held is not None and (held[6] or held[5] == BY_SPAN):
            yield _spans(*(np.array([x]) for x in held[2:5]), True)

    return run


def _spans(d, s, n, is_open: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(d, type=pa.int64()), pa.array(s, type=pa.int32()), pa.array(n, type=pa.int32()),
         pa.array(np.full(len(d), is_open))], names=["d", "s", "n", "open"],
    )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each row's start and end; missing lists are empty."""
    lengths = np.array(column.value_lengths().fill_null(0))
    return np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(lengths)])


def _windows(length: int):
    def make(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        """Every window of the open runs of a text as ``(hashes of both halves, row, start, 1)``."""
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        starts, at = _lists(batch.column(2))
        counts, _ = _lists(batch.column(3))
        for p in pieces(batch.column(1), length - 1):
            lo, hi = at[p.first], at[p.first + len(p.starts)]
            owner = np.repeat(np.arange(len(p.starts)), np.diff(at[p.first : p.first + len(p.starts) + 1]))
            n = counts[lo:hi].astype(np.int64)
            which = np.repeat(np.arange(hi - lo), n)
            s = starts[lo:hi].astype(np.int64)[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) - p.base
            text = owner[which]
            begin = p.starts[text] + s
            there = (s >= 0) & (begin + length <= p.ends[text])
            begin, s, text = begin[there], s[there], text[there]
            if len(begin):
                slices, middle = Slices(p.data), begin + length // 2
                high, low = slices.hashes(begin, middle), slices.hashes(middle, begin + length)
                yield high, low, ids[p.first + text], s + p.base, np.ones(len(high), dtype=np.int64)

    return make


def _grouped(spans: DataFrame) -> DataFrame:
    """The spans of each row as two lists; a text of n bytes has at most n spans."""
    both = spans.groupBy("d").agg(F.collect_list(F.struct("s", "n")).alias("_x"))
    return both.select(
        F.col("d").alias("_row"), F.transform("_x", lambda x: x["s"]).alias("_starts"),
        F.transform("_x", lambda x: x["n"]).alias("_counts"),
    )


def _dealt(runs: DataFrame) -> DataFrame:
    """Equal rows in one partition, with all of their digit unless it is crowded; those known to repeat
    need no company and go anywhere."""
    return runs.repartition(
        F.when(F.col("way") == KNOWN, F.xxhash64("d", "s")).when(F.col("way") == BY_SPAN, F.xxhash64("a", "h"))
        .otherwise(F.col("a"))
    )


def crowded_digits(rows: DataFrame, length: int = 100, sampled: int = SAMPLED_DOCUMENTS) -> np.ndarray:
    """The digits, at most ``CROWDED_DIGITS``, in most different runs of about ``sampled`` documents."""
    every = max(1, rows.count() // sampled)
    some = rows.filter(F.pmod(F.xxhash64("_row"), F.lit(every)) == 0).select("_row", "_text")
    runs = some.mapInArrow(
        _collect(lambda b: _runs(b.column(0), b.column(1), length), np.zeros(0, dtype=np.int64)), RUNS
    )
    found = (
        runs.filter(F.col("way") != KNOWN).groupBy("a", "h").agg(F.lit(1)).groupBy("a").agg(F.count("*").alias("c"))
        .filter(F.col("c") >= CROWDED_RUNS).orderBy(F.desc("c"), "a").limit(CROWDED_DIGITS)
    )
    return np.array([r["a"] for r in found.select("a").collect()], dtype=np.int64)


def repeated_spans(rows: DataFrame, length: int = 100) -> DataFrame:
    """``(d, s, n)`` for ``rows`` (``_row, _text``): the windows of ``length`` bytes that start at
    ``s`` ... ``s + n - 1`` of row ``d`` also start earlier, in a smaller row or further left.

    Every window that does is in a span.  Equal runs are taken together within each task before
    the shuffle, so a passage in a third of all texts sends few rows to the task of its digit, and
    tasks stream over sorted rows without gathering a group.
    """
    spark = rows.sparkSession
    with freed_shuffles(spark):
        crowded = crowded_digits(rows, length)
        runs = rows.select("_row", "_text").mapInArrow(
            _collect(lambda b: _runs(b.column(0), b.column(1), length), crowded), RUNS
        )
        found = settle(
            _dealt(runs).sortWithinPartitions("a", "h", "d", "s").mapInArrow(_equal_runs(True), SPANS)
        )
        windows = (
            rows.join(_grouped(found.filter("open")), "_row").select("_row", "_text", "_starts", "_counts")
            .mapInArrow(_collect(_windows(length), None), RUNS)
        )
        single = settle(
            _dealt(windows).sortWithinPartitions("a", "h", "d", "s").mapInArrow(_equal_runs(False), SPANS)
        )
    return found.filter("NOT open").unionByName(single).select("d", "s", "n")


def _cover(starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Union of the byte ranges ``[s, s + n - 1 + length)``: begins and ends of its maximal runs."""
    order = np.argsort(starts, kind="stable")
    begin = starts[order].astype(np.int64)
    end = np.maximum.accumulate(begin + counts[order] - 1 + length)
    new = np.ones(len(begin), dtype=bool)
    new[1:] = begin[1:] > end[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
    return begin[new], end[last]


def _whole_characters(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shrink ranges to whole UTF-8 characters."""
    leads = np.flatnonzero((text & 0xC0) != 0x80)
    edges_of = np.append(leads, len(text))
    begin = edges_of[np.searchsorted(edges_of, begin, side="left")]
    end = edges_of[np.searchsorted(edges_of, end, side="right") - 1]
    fine = begin < end
    return begin[fine], end[fine]


def _cut(length: int, with_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, at = _lists(batch.column("_starts"))
            counts, _ = _lists(batch.column("_counts"))
            out: list[tuple] = []
            texts = []
            for i, value in enumerate(batch.column("_text")):
                data = value.as_buffer() if value.is_valid else pa.py_buffer(b"")
                raw = np.frombuffer(data, dtype=np.uint8)
                kept, removed, n_spans = data, 0, 0
                if at[i] < at[i + 1]:
                    begin, end = _cover(starts[at[i] : at[i + 1]], counts[at[i] : at[i + 1]], length)
                    if with_text:
                        begin, end = _whole_characters(raw, begin, end)
                    edge = np.zeros(len(raw) + 1, dtype=np.int8)
                    edge[begin] += 1
                    edge[end] -= 1
                    kept = raw[np.cumsum(edge[:-1]) == 0].tobytes()
                    removed, n_spans = len(raw) - len(kept), len(begin)
                if with_text:
                    texts.append(str(kept, "utf-8"))
                else:
                    out.append((len(raw), removed, n_spans, hashlib.sha256(kept).hexdigest()))
            if with_text:
                names = [c for c in batch.schema.names if c not in ("_starts", "_counts", "_text")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(texts, type=pa.string())], names=[*names, "_kept"]
                )
            else:
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), *(pa.array(c, type=t) for c, t in zip(
                        columns, [pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True))],
                    names=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return run


def _with_spans(rows: DataFrame, length: int) -> DataFrame:
    return rows.join(_grouped(repeated_spans(rows.select("_row", "_text"), length)), "_row", "left")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a document
    with a smaller id or further left in the same one.  All strings are judged on the input.

    A missing text is empty and keeps nothing; texts shorter than ``length`` are kept whole.  Missing
    ids come first; rows that share an id are documents of their own in the order of their texts, so
    of repeated rows the first is kept.  An empty table gives an empty result.
    """
    cut = _with_spans(ordered_rows(docs, id_col, text), length).select("_id", "_text", "_starts", "_counts")
    done = cut.mapInArrow(_cut(length, False), "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return done.withColumnRenamed("_id", id_col)


def kept_texts(rows: DataFrame, length: int = 100, keep: Sequence[str] = ("_row", "_id")) -> DataFrame:
    """``keep`` and ``_kept``: the texts of ``rows`` (see ``keyed``) without repeats.

    A character goes only if all its bytes do, so that what is left is text.
    """
    cut = _with_spans(rows, length).select(*keep, "_text", "_starts", "_counts")
    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in keep)
    return cut.mapInArrow(_cut(length, True), f"{kinds}, _kept string")
