"""Quality rules: decision lists learned from labelled statistics by sequential covering.

A rule is a conjunction of thresholds on statistics of a text.  Rules are grown on one part of the
labelled rows, pruned on the other, and applied in order as one Spark conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import BLANKS, compute_once, settle, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Name of a feature → SQL over the statistics; every one is 0 for a text without words.
FEATURES = {
    "n_words": "double(n_words)",
    "mean_word_chars": "coalesce(word_chars / nullif(n_words, 0), 0)",
    "symbols_per_word": "coalesce(n_symbols / nullif(n_words, 0), 0)",
    "repeat_share": "coalesce(n_repeat_words / nullif(n_words, 0), 0)",
    "dup_lines_per_word": "coalesce(n_dup_lines / nullif(n_words, 0), 0)",
    "capitals_per_char": "coalesce(n_capitals / nullif(word_chars, 0), 0)",
    "distinct_share": "coalesce(n_distinct / nullif(n_words, 0), 0)",
}


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}D"


class Rule(NamedTuple):
    """A text is rejected when all conditions hold; the counts are those of the labelled rows."""

    conditions: tuple[Condition, ...]
    rejected_bad: int
    rejected_good: int

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def text_statistics(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the statistics of each text; a missing or empty text has zeros throughout.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a
    word that equal an earlier line), ``n_repeat_words`` (words inside three-word windows that occur
    twice or more in the text), ``n_capitals`` (A-Z), ``n_distinct`` (different words).

    Everything is computed in the row, without a shuffle.  Windows are compared by a 64-bit hash of
    their words; sorting (hash, position) brings equal ones together in O(n log n), also in very
    long texts.  Repeated rows are counted each on their own.
    """
    given = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: _without(line, BLANKS) != "")
    solid = _without(F.col("_text"), BLANKS)
    split = compute_once(
        given.withColumn("_solid", solid), _words=words(F.col("_text")), _lines=lines,
        word_chars=F.length("_solid"),
        n_symbols=F.length("_solid") - F.length(_without(F.col("_solid"), SYMBOLS)),
        n_capitals=F.length("_solid") - F.length(_without(F.col("_solid"), CAPITALS)),
    )
    w, n = F.col("_words"), F.size("_words")
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(
        starts,
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
    )
    ordered = compute_once(
        split, _sorted=F.sort_array(window), n_words=n.cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_distinct=F.size(F.array_distinct("_words")).cast("long"),
    )
    s = F.col("_sorted")

    def repeated(x: Column, k: Column) -> Column:
        before = F.get(s, k - 1)["h"].eqNullSafe(x["h"])
        return before | F.get(s, k + 1)["h"].eqNullSafe(x["h"])

    places = compute_once(
        ordered, _places=F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["i"]))
    )
    # Each window covers three words, up to where the next one starts.
    p = F.col("_places")
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    return places.select(
        *keep, "n_words", F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"), "n_dup_lines",
        covered.alias("n_repeat_words"), F.col("n_capitals").cast("long").alias("n_capitals"), "n_distinct",
    )


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )


def fit_rules(
    labelled: DataFrame,
    bad: str = "bad",
    features: Mapping[str, str] = FEATURES,
    seed_col: str = "doc_id",
    max_rules: int = 8,
    max_conditions: int = 3,
    n_cuts: int = 63,
    min_precision: float = 0.95,
    min_rejected: int = 10,
) -> list[Rule]:
    """Ordered rules that reject rows whose boolean ``bad`` is true.

    Sequential covering: grow a conjunction on two thirds of the rows (by hash of ``seed_col``) by
    the threshold with the largest information gain, cut it back to the prefix that does best on the
    other third, keep it if it rejects at least ``min_rejected`` bad rows and is right in
    ``min_precision`` of its rejections there, take its rows away and go on.  Rows with a missing
    label are not used; without bad rows there are no rules.

    Each step is one aggregation over all labelled rows; only counts by (feature, cut), whose number
    the parameters fix, come to the driver.  Thresholds are approximate quantiles of all rows.
    """
    names = list(features)
    rows = labelled.filter(F.col(bad).isNotNull()).select(
        F.col(bad).alias("bad"), (F.pmod(F.xxhash64(seed_col), F.lit(3)) != 0).alias("grow"),
        *[F.expr(sql).cast("double").alias(f) for f, sql in features.items()],
    )
    quantiles = [k / (n_cuts + 1) for k in range(1, n_cuts + 1)]
    found = rows.agg(*[F.percentile_approx(f, quantiles, 10_000).alias(f) for f in names]).head()
    cuts = {f: sorted(set(found[f] or [])) for f in names}
    if not any(cuts.values()):
        return []
    # The number of the first cut that is not below the value, as a whole number per feature.
    binned = settle(rows.select(
        "bad", "grow",
        *[_cuts_below(F.col(f), cuts[f]).alias(f) for f in names],
    ))

    def holds(conditions: Iterable[Condition]) -> Column:
        test = F.lit(True)
        for c in conditions:
            k = cuts[c.feature].index(c.threshold)
            test = test & ((F.col(c.feature) > k) if c.above else (F.col(c.feature) <= k))
        return test

    rules: list[Rule] = []
    left = binned
    while len(rules) < max_rules:
        conditions: list[Condition] = []
        for _ in range(max_conditions):
            best = _best_condition(left.filter(F.col("grow") & holds(conditions)), names, cuts)
            if best is None:
                break
            conditions.append(best)
        if not conditions:
            break
        prefixes = [conditions[:k] for k in range(1, len(conditions) + 1)]
        counts = left.agg(*[
            F.count_if(holds(p) & (F.col("bad") == b) & (F.lit(whole) | ~F.col("grow"))).alias(f"{k}{b}{whole}")
            for k, p in enumerate(prefixes) for b in (True, False) for whole in (True, False)
        ]).head()

        def worth(k: int) -> tuple[float, int]:
            p, n = counts[f"{k}TrueFalse"], counts[f"{k}FalseFalse"]
            return ((p - n) / (p + n) if p + n else -1.0, -k)

        k = max(range(len(prefixes)), key=worth)
        held_bad, held_good = counts[f"{k}TrueFalse"], counts[f"{k}FalseFalse"]
        all_bad, all_good = counts[f"{k}TrueTrue"], counts[f"{k}FalseTrue"]
        if all_bad < min_rejected or not held_bad or held_bad < min_precision * (held_bad + held_good):
            break
        rules.append(Rule(tuple(prefixes[k]), all_bad, all_good))
        left = left.filter(~holds(prefixes[k]))
    return rules


def _cuts_below(value: Column, cuts: Sequence[float]) -> Column:
    return F.size(F.filter(F.lit(list(cuts)).cast("array<double>"), lambda c: c < value))


def _best_condition(rows: DataFrame, names: Sequence[str], cuts: Mapping[str, list[float]]) -> Condition | None:
    """The threshold of largest gain p * (log p/(p+n) - log P/(P+N)), or None without a gain."""
    by_cut = rows.select(
        "bad", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("k")) for f in names])).alias("x")
    ).groupBy("x.f", "x.k").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
    counts: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in names}
    for f, k, p, n in by_cut.collect():
        counts[f][k] = (p, n)
    all_p = sum(p for p, _ in counts[names[0]].values())
    all_n = sum(n for _, n in counts[names[0]].values())
    if not all_p or not all_n:
        return None
    best, found = 1e-9, None
    for f in names:
        below_p = below_n = 0
        for k, cut in enumerate(cuts[f]):
            p, n = counts[f].get(k, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, (p, n) in ((False, (below_p, below_n)), (True, (all_p - below_p, all_n - below_n))):
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n)))
                    if gain > best:
                        best, found = gain, Condition(f, above, cut)
    return found


def decision(rules: Sequence[Rule], features: Mapping[str, str] = FEATURES) -> Column:
    """The number of the first rule that rejects a row of statistics, from 1; 0 if none does."""
    chain = "".join(f" WHEN {_over(r, features)} THEN {k}" for k, r in enumerate(rules, start=1))
    return F.expr(f"CASE{chain} ELSE 0 END") if rules else F.lit(0)


def _over(rule: Rule, features: Mapping[str, str]) -> str:
    return " AND ".join(
        f"({features[c.feature]}) {'>' if c.above else '<='} {c.threshold!r}D" for c in rule.conditions
    )


def quality_verdicts(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
    quality: str = "quality",
) -> DataFrame:
    """One row per document: its statistics, ``base_failed``, ``rule`` and ``kept``.

    ``rule`` is the number of the first learned rule that rejects it, 0 for none; ``kept`` is false
    if ``base_failed`` or a rule rejects.  Statistics are computed once into a table of a few
    numbers per document; learning joins it with ``labels`` (0: bad).  A missing id joins no label.
    Repeated label rows count repeatedly.  Without labels only the base test rejects.
    """
    stats = settle(text_statistics(documents, text, keep=[id_col]))
    known = labels.filter(F.col(quality).isNotNull()).select(id_col, (F.col(quality) == 0).alias("bad"))
    failed = base_failed()
    rules = fit_rules(stats.filter(~failed).join(known, id_col), seed_col=id_col)
    rule = decision(rules)
    return stats.select(
        id_col, *BASE, failed.alias("base_failed"), (~failed & (rule == 0)).alias("kept"),
        F.when(failed, 0).otherwise(rule).alias("rule"),
    )
