"""Token counts of texts, with huge documents encoded in overlapping chunks.

A chunk's encoding is right from the first true boundary between pre-tokens on.  A blank before a letter
or digit always starts a pre-token of a byte-level tokenizer, so a place where the encodings of two
neighbouring chunks both start a token at such a blank is a boundary of the whole text, and the
encodings are spliced there.  Where an overlap holds no such place it is widened.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modspark.llm.common import ordered_rows, settle

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
MEMO_PIECES = 400_000

# Texts in which a cut at every blank and line break could miss how white space or special strings
# are joined; they are encoded whole.
_UNSURE = re.compile(r"\s\s|^\s|\s\Z|[^\S \n]|<\|")


class _Counter:
    """Counts tokens with the library; pieces between sure boundaries are remembered."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memo: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        unsure = [i for i, t in enumerate(texts) if _UNSURE.search(t)]
        for i, n in zip(unsure, self.whole([texts[i] for i in unsure]), strict=True):
            out[i] = n
        skip = set(unsure)
        # Every white space here is one blank or one line break between other characters.  A blank
        # belongs to the word behind it, a line break is a piece of its own.
        split = {i: t.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0") for i, t in enumerate(texts) if i not in skip and t}
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        new = list({p for pieces in split.values() for p in pieces} - self.memo.keys())
        self.memo.update(zip(new, self.whole(new), strict=True))
        for i, pieces in split.items():
            out[i] = sum(map(self.memo.__getitem__, pieces))
        return out


def _counted(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                # A text with the separator goes to the library whole.
                texts = part.column("_text").to_pylist()
                plain = [i for i, t in enumerate(texts) if "\0" not in t]
                odd = [i for i, t in enumerate(texts) if "\0" in t]
                n = dict(zip(plain, counter.count([texts[i] for i in plain]), strict=True))
                n |= dict(zip(odd, counter.whole([texts[i] for i in odd]), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), pa.array([n[i] for i in range(len(texts))], type=pa.int64())], names=["_row", "n"]
                )

    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text"), strict=True):
                text = text.as_py()
                n = max(1, -(-len(text) // chunk))
                for first in range(0, n, 64):
                    k = range(first, min(n, first + 64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(k), type=pa.int64()), pa.array(k, type=pa.int64()),
                         pa.array([j == n - 1 for j in k]),
                         pa.array([text[j * chunk : (j + 1) * chunk + (0 if j == n - 1 else overlap)] for j in k])],
                        names=["_row", "k", "last", "piece"],
                    )

    return run


PLACES = "array<struct<at: long, before: long>>"


def _encoded(path: str, chunk: int, overlap: int):
    def places(text: str, starts: list[int], lo: int, hi: int, shift: int) -> list[dict]:
        """Sure boundaries in ``lo <= place < hi``: where in the text, and how many tokens come before."""
        return [
            {"at": p + shift, "before": j} for j, p in enumerate(starts)
            if lo <= p < hi and p + 1 < len(text) and text[p] == " " and text[p + 1].isalnum()
        ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _Counter(path).library
        kind = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
        for batch in batches:
            for begin in range(0, batch.num_rows, 16):
                part = batch.slice(begin, 16)
                pieces, ks = part.column("piece").to_pylist(), part.column("k").to_pylist()
                heads, tails, counts = [], [], []
                for text, k, e in zip(pieces, ks, library.encode_batch(pieces, add_special_tokens=False), strict=True):
                    starts = [o[0] for o in e.offsets]
                    heads.append(places(text, starts, 0, overlap, k * chunk))
                    tails.append(places(text, starts, chunk, chunk + overlap, k * chunk))
                    counts.append(len(starts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("k"), part.column("last"), pa.array(heads, type=kind),
                     pa.array(tails, type=kind), pa.array(counts, type=pa.int64())],
                    names=["_row", "k", "last", "head", "tail", "n"],
                )

    return run


def spliced_counts(rows: DataFrame, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``(_row, n)``: tokens of long texts; ``n`` is null where some overlap has no common boundary.

    Chunks of one text are spread over tasks; of each, its count and the sure boundaries in its
    overlaps go on, a few numbers that meet again by text.
    """
    chunks = rows.select("_row", "_text").mapInArrow(_cut(chunk, overlap), "_row long, k long, last boolean, piece string")
    encoded = chunks.repartition("_row", "k").mapInArrow(
        _encoded(path, chunk, overlap),
        f"_row long, k long, last boolean, head {PLACES}, tail {PLACES}, n long",
    )
    following = F.lead("head").over(Window.partitionBy("_row").orderBy("k"))
    at = F.array_min(F.array_intersect(
        F.transform("tail", lambda x: x["at"]), F.transform("_next", lambda x: x["at"])
    ))

    def before(list_col: str):
        return F.get(F.filter(list_col, lambda x: x["at"] == F.col("_at")), F.lit(0))["before"]

    # Up to its end boundary a chunk counts all its tokens; the next gives back those before it.
    own = F.when(F.col("last"), F.col("n")).otherwise(before("tail") - before("_next"))
    return (
        encoded.withColumn("_next", following).withColumn("_at", at).withColumn("_own", own)
        .groupBy("_row").agg(
            F.when(F.count("_own") == F.count("*"), F.sum("_own")).alias("n")
        )
    )


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", limit: int = 512,
    chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    ``path`` is a tokenizer file of the byte-level kind, the same on every machine.  Counts are those of the
    library for the whole text, without added special tokens; special strings in texts are
    tokens, as is its default.  Texts of up to ``chunk`` characters are counted in place; longer ones in
    chunks.  If the chunks of a text cannot be spliced, they are cut again with an overlap four times as
    wide, and in the end the text is one chunk.

    A missing text is empty and has 0 bytes and tokens.  Rows with missing or repeated ids count each
    on their own.
    """
    rows = ordered_rows(docs, id_col, text)
    long = F.length("_text") > chunk
    parts = [rows.filter(~long).select("_row", "_text").mapInArrow(_counted(path), "_row long, n long")]
    left, size, wide = rows.filter(long), chunk, overlap
    if left.limit(1).count():
        while True:
            done = settle(spliced_counts(left, path, size, wide))
            parts.append(done.filter("n IS NOT NULL"))
            if not done.filter("n IS NULL").limit(1).count():
                break
            left = settle(left.join(done.filter("n IS NULL").select("_row"), "_row", "left_semi"))
            wide *= 4
            size = max(size, 2 * wide)
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    sizes = rows.select("_row", "_id", F.octet_length("_text").cast("long").alias("n_bytes"))
    return sizes.join(counts, "_row").select(
        F.col("_id").alias(id_col), "n_bytes", F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit")
    )
