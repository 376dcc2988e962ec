"""License scans: short notices found with spelling errors, and fixed phrases found word by word.

A notice that may differ in k characters is cut into k + 1 pieces, one of which stands unchanged in
every place that matches.  All pieces of all notices are looked up in one pass of an Aho-Corasick
automaton; around each hit the regex library's bounded-error matching decides and reports the span.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS = 200_000
MEMO_WINDOWS = 20_000

# A-Z in lower case; every other ASCII character that is no digit or small letter as a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Phrase(NamedTuple):
    """Words that must stand one after the other."""

    label: str
    text: str


class Notice(NamedTuple):
    """A notice in words, and how many characters may be inserted, deleted or replaced."""

    label: str
    text: str
    edits: int


PHRASES = (Phrase("mit", "mit license"), Phrase("apache", "apache license"), Phrase("gpl", "general public license"))

NOTICES = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "under the terms of the gnu general public license", 4),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("agpl", "gnu affero general public license", 2),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 8),
    Notice("cc-by-nc", "licensed under cc by nc", 0),
    Notice("cc-by-nc", "creative commons attribution noncommercial", 3),
)


def pieces(text: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of a notice with their places."""
    n = edits + 1
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Looks for phrases and notices in the words of one text after the other."""

    def __init__(self, phrases: Sequence[Phrase], notices: Sequence[Notice], block: int = BLOCK_WORDS):
        import ahocorasick
        import regex

        self.phrases = [(p.label, " ".join(p.text.split())) for p in phrases]
        self.notices = [Notice(n.label, " ".join(n.text.split()), n.edits) for n in notices]
        if any(not n.text or n.edits < 0 or n.edits >= len(n.text) for n in self.notices) or not all(t for _, t in self.phrases):
            raise ValueError("phrases and notices need words, and notices more characters than edits")
        self.patterns = [
            regex.compile(r"(?e)(?<![^ ])(?:%s){e<=%d}(?![^ ])" % (regex.escape(n.text, literal_spaces=True), n.edits))
            for n in self.notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(self.notices):
            for at, piece in pieces(n.text, n.edits):
                seeds.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        # No match reaches over more words than this.
        self.ahead = max([0, *(len(t) for _, t in self.phrases), *(len(n.text) + n.edits for n in self.notices)])
        self.block = block
        self.memo: dict[tuple[int, str], list[tuple[int, int, int]]] = {}

    def _windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Whole words that hold all matches of a notice; windows that overlap are one."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for k, at in places:
                n = self.notices[k]
                begin = text.rfind(" ", 0, max(0, end + 1 - size - at - n.edits)) + 1
                stop = text.find(" ", end + 1 + len(n.text) - at - size + n.edits)
                stop = len(text) if stop < 0 else stop
                spans = found.setdefault(k, [])
                while spans and begin <= spans[-1][1]:
                    earlier = spans.pop()
                    begin, stop = min(begin, earlier[0]), max(stop, earlier[1])
                spans.append([begin, stop])
        for k, spans in found.items():
            for begin, stop in spans:
                yield k, begin, stop

    def _notices(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``(notice, begin, end, edits)`` in characters of a text of words with single blanks."""
        for k, begin, stop in self._windows(text):
            window = text[begin:stop]
            spans = self.memo.get((k, window))
            if spans is None:
                if len(self.memo) > MEMO_WINDOWS:
                    self.memo.clear()
                spans = [(m.start(), m.end(), sum(m.fuzzy_counts)) for m in self.patterns[k].finditer(window)]
                if len(window) < 1_000:
                    self.memo[k, window] = spans
            for a, b, edits in spans:
                yield k, a + begin, b + begin, edits

    def scan(self, text: str) -> tuple[int, list[tuple[str, bool, int, int, int, float]]]:
        """The number of words, and spans ``(label, is phrase, first word, words, edits, score)``."""
        all_words = text.encode().translate(_WORD_BYTES).split()
        found: list[tuple[str, bool, int, int, int, float]] = []
        until = [0] * len(self.notices)
        for base in range(0, max(1, len(all_words)), self.block):
            block = str(b" ".join(all_words[base:base + self.block + self.ahead]), "utf-8")
            closed = f" {block} "
            hits = []
            for label, phrase in self.phrases:
                at, size = closed.find(f" {phrase} "), phrase.count(" ") + 1
                while at >= 0:
                    hits.append((at, size, label, None, 0, 1.0))
                    at = closed.find(f" {phrase} ", at + 1)
            for k, begin, end, edits in self._notices(block):
                n = self.notices[k]
                hits.append((begin, block.count(" ", begin, end) + 1, n.label, k, edits, 1 - edits / len(n.text)))
            place = before = 0
            for at, size, label, k, edits, score in sorted(hits, key=lambda h: h[0]):
                before += block.count(" ", place, at)
                place = at
                first = base + before
                # What starts behind the block's own words is the next block's; a notice that the block
                # before has found to the end of its words is not found again in its rest.
                if before < self.block and (k is None or first >= until[k]):
                    found.append((label, k is None, first, size, edits, score))
                    if k is not None:
                        until[k] = first + size
        return len(all_words), found


SPANS = "array<struct<label:string,phrase:boolean,first_word:long,n_words:long,edits:long,score:double>>"


def _scanned(phrases: Sequence[Phrase], notices: Sequence[Notice]):
    kind = pa.list_(pa.struct([
        ("label", pa.string()), ("phrase", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()),
        ("edits", pa.int64()), ("score", pa.float64()),
    ]))
    names = ["label", "phrase", "first_word", "n_words", "edits", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        for batch in batches:
            sizes, spans = [], []
            for text in batch.column("_text"):
                n, found = scanner.scan(text.as_py())
                sizes.append(n)
                spans.append([dict(zip(names, s, strict=True)) for s in sorted(found, key=lambda s: (s[2], not s[1], s[0]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, type=pa.int64()), pa.array(spans, type=kind)],
                names=["_id", "n_words", "spans"],
            )

    return run


def license_spans(
    docs: DataFrame, phrases: Sequence[Phrase] = PHRASES, notices: Sequence[Notice] = NOTICES,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(id, n_words, spans)`` for every row; a span tells label, kind, first word, words, edits, score.

    Words are runs of a-z (A-Z in lower case), 0-9 and all characters beyond ASCII.  A phrase span is a
    place where its words stand one after the other, places may overlap.  A notice span covers whole
    words whose text, with single blanks between, is at most ``edits`` insertions, deletions and
    replacements from the notice; a notice is found whenever the text holds such words, and its spans
    do not overlap each other.  ``score`` is 1 for a phrase, else the share of the notice not edited.

    A missing text is empty and has no words.  Repeated rows and missing ids give a row each, other
    columns are ignored, an empty table gives no rows.  A long text is read in blocks of words which
    overlap by the longest possible match.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return rows.mapInArrow(
        _scanned(tuple(phrases), tuple(notices)), f"_id long, n_words long, spans {SPANS}"
    ).withColumnRenamed("_id", id_col)


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def scan_licenses(
    docs: DataFrame, phrases: Sequence[Phrase] = PHRASES, notices: Sequence[Notice] = NOTICES,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Digest of ``license_spans``: phrases found, first and last start, labels by phrases and by all, best score."""
    found = license_spans(docs, phrases, notices, id_col, text)
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["first_word"])
    return found.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
        F.size(F.filter("spans", lambda s: ~s["phrase"])).cast("long").alias("n_notices"),
    )
