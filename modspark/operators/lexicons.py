"""Counting lexicon words and policy phrases per text.

Three plans with equal results.  A lexicon of at most ``INLINE_LIMIT`` rows becomes hash sets inside
the plan; a larger one, as far as a broadcast may go, a trie over words that is looked up in the row.
In both every text is scored in place and nothing is shuffled or written.  Beyond ``trie_limit`` rows
the lexicon is joined to the words of the text by a row id made here; ``id_col`` is accepted and not needed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.functions import text as T
from modspark.operators import automaton
from modspark.operators.automaton import ANY
from modspark.operators.joins import BROADCAST_LIMIT, INLINE_LIMIT, column, is_small, lookup_join, rows_or_frame
from modspark.operators.rows import compute_once, with_row_id


def _per_language(langs: Iterable[str], build: Callable[[str], str]) -> Column:
    """``build(language)`` for listed values of ``_code``, ``build('*')`` for all others."""
    cases = " ".join(f"WHEN _code IN {T.sql_list([c])} THEN {build(c)}" for c in sorted(langs))
    return F.expr(f"CASE {cases} ELSE {build(ANY)} END" if cases else build(ANY))


def count_hits(
    df: DataFrame,
    lexicon: DataFrame | Iterable[tuple[str, str, str]],
    classes: Sequence[str],
    *,
    tokens: str = "_tokens",
    lang: str | Column = "lang",
    id_col: str | None = None,
    prefix: str = "hits_",
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add ``<prefix><class>`` = words of ``tokens`` found in that class for the text's language.

    ``lexicon`` has (class, word, lang); ``lang='*'`` applies to every text.
    """
    rows, frame = rows_or_frame(lexicon, ["class", "word", "lang"], inline_limit)
    lang = column(lang)
    if rows is None and not is_small(frame, trie_limit):
        return _count_hits_by_join(df, frame, classes, tokens, lang, prefix)
    if rows is None:
        number = {c: i for i, c in enumerate(classes)}
        entries = [(number[r[0]], (r[1],), r[2]) for r in frame.collect() if r[0] in number and r[1] is not None]
        counted = compute_once(df, _counts=automaton.class_counts(
            df.sparkSession, entries, len(classes), F.col(tokens), lang.cast("string")))
        return counted.withColumns({f"{prefix}{c}": F.get("_counts", F.lit(i)) for c, i in number.items()}).drop("_counts")

    words: dict[tuple[str, str], set[str]] = defaultdict(set)
    for cls, word, code in rows:
        words[cls, code].add(word)
    langs = {code for _, code in words} - {ANY}

    def wanted(cls: str, code: str) -> set[str]:
        return words[cls, code] | words[cls, ANY]

    def union(code: str) -> set[str]:
        return set().union(*(wanted(c, code) for c in classes))

    # One look at every word; the classes then only see words that are in the lexicon.
    pruned = compute_once(
        df.withColumn("_code", lang),
        _known=_per_language(langs, lambda code: T.keep_sql(tokens, union(code))),
    )
    counts = {
        f"{prefix}{cls}": _per_language(
            langs, lambda code, cls=cls: T.hits_sql("_known", wanted(cls, code))
        )
        for cls in classes
    }
    return pruned.withColumns(counts).drop("_known", "_code")


def _count_hits_by_join(df, lexicon, classes, tokens, lang, prefix) -> DataFrame:
    df = with_row_id(df)
    entries = lexicon.groupBy("word").agg(
        F.collect_set(F.struct(F.col("class"), F.col("lang"))).alias("_entries")
    )
    words = df.select("_rid", lang.alias("_lang"), F.explode(tokens).alias("word"))
    found = lookup_join(words, entries, "word", ["_rid"], "inner")

    def in_class(cls: str) -> Column:
        return F.exists(
            "_entries",
            lambda e: (e["class"] == cls)
            & ((e["lang"] == ANY) | F.coalesce(e["lang"] == F.col("_lang"), F.lit(False))),
        )

    sums = [
        F.count(F.when(in_class(c), 1)).cast("int").alias(f"{prefix}{c}")
        for c in classes
    ]
    per_text = found.groupBy("_rid").agg(*sums)
    joined = df.join(per_text, "_rid", "left").drop("_rid")
    return joined.withColumns(
        {f"{prefix}{c}": F.coalesce(F.col(f"{prefix}{c}"), F.lit(0)) for c in classes}
    )


POLICY_COUNTS = "array<struct<category_no:int,category:string,n:int>>"


def policy_hits(
    df: DataFrame,
    policy: DataFrame | Iterable[tuple[int, str, str, str]],
    *,
    tokens: str = "_tokens",
    lang: str | Column = "lang",
    id_col: str | None = None,
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add ``policy_counts`` (hits per category, in policy order) and ``policy_matched`` (phrases).

    ``policy`` has (category_no, category, phrase, lang); a phrase matches wherever its words stand
    next to each other, overlaps included.
    """
    columns = ["category_no", "category", "phrase", "lang"]
    rows, frame = rows_or_frame(policy, columns, inline_limit)
    lang = column(lang)
    if rows is None and not is_small(frame, trie_limit):
        return _policy_hits_by_join(df, frame, tokens, lang)
    if rows is None:
        return _policy_hits_by_trie(df, [tuple(r) for r in frame.collect()], tokens, lang)

    phrases: dict[tuple[int, str], set[str]] = defaultdict(set)
    names: dict[int, str] = {}
    for number, category, phrase, code in rows:
        phrases[number, code].add(phrase)
        names[number] = category
    if not names:
        return df.withColumns({"policy_counts": F.array().cast(POLICY_COUNTS),
                               "policy_matched": F.array().cast("array<string>")})
    langs = {code for _, code in phrases} - {ANY}

    def wanted(number: int, code: str) -> set[str]:
        return phrases[number, code] | phrases[number, ANY]

    def union(code: str) -> set[str]:
        return set().union(*(wanted(n, code) for n in names))

    def counts(code: str) -> str:
        each = ", ".join(
            f"named_struct('category_no', {int(n)}, 'category', {T.sql_list([names[n]])},"
            f" 'n', {T.hits_sql('_found', wanted(n, code))})"
            for n in sorted(names)
        )
        return f"filter(array({each}), c -> c.n > 0)"

    hit = compute_once(
        df.withColumn("_code", lang),
        _found=_per_language(langs, lambda code: T.phrases_sql(tokens, union(code))),
    )
    return hit.withColumns(
        {
            # Most texts match nothing and skip the per-category work.
            "policy_counts": F.when(F.size("_found") > 0, _per_language(langs, counts)).otherwise(
                F.array().cast(POLICY_COUNTS)
            ),
            "policy_matched": F.array_sort(F.array_distinct("_found")),
        }
    ).drop("_found", "_code")


def _policy_hits_by_trie(df, rows, tokens, lang) -> DataFrame:
    names = {number: category for number, category, _, _ in rows}
    entries = [(number, tuple(phrase.split(" ")), code) for number, _, phrase, code in rows if phrase]
    hit = compute_once(df, _hits=automaton.phrase_hits(df.sparkSession, entries, F.col(tokens), lang.cast("string")))
    category = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.create_map()
    numbers = F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["class"])))
    counts = F.transform(numbers, lambda c: F.struct(
        c.alias("category_no"), F.element_at(category, c).alias("category"),
        F.aggregate(F.filter("_hits", lambda h: h["class"] == c), F.lit(0), lambda acc, h: acc + h["n"]).alias("n"),
    ))
    none = F.array().cast(POLICY_COUNTS)
    return hit.withColumns({
        "policy_counts": F.when(F.size("_hits") > 0, counts).otherwise(none).cast(POLICY_COUNTS),
        "policy_matched": F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["phrase"]))),
    }).drop("_hits")


def _policy_hits_by_join(df, policy, tokens, lang) -> DataFrame:
    df = with_row_id(df)
    words = F.size(F.split("phrase", " "))
    sizes = [r[0] for r in policy.select(words).distinct().collect()]
    entries = policy.groupBy("phrase").agg(
        F.collect_set(F.struct("category_no", "category", "lang")).alias("_entries")
    )
    # Phrases are put together only where the first word of one stands; every other place is one row, unjoined.
    sizes = [n for n in sizes if n and n > 0]
    firsts = policy.select(F.get(F.split("phrase", " "), F.lit(0)).alias("_first")).filter("_first IS NOT NULL").distinct()
    # A place and the words after it, NULL past the end, by whole arrays and not word by word.
    ahead = [f"_w{k}" for k in range(max(sizes, default=1))]
    shifted = [F.slice(tokens, k + 1, F.greatest(F.size(tokens), F.lit(0))) for k in range(len(ahead))]
    places = df.select("_rid", lang.alias("_lang"), F.inline(F.arrays_zip(*shifted))).toDF("_rid", "_lang", *ahead)
    started = lookup_join(places.withColumnRenamed("_w0", "_first"), firsts, "_first", ["_rid"], "inner")
    ahead[0] = "_first"
    phrases = [F.when(F.col(ahead[n - 1]).isNotNull(), F.concat_ws(" ", *ahead[:n])) for n in sizes]
    grams = started.select("_rid", "_lang", F.explode(F.array_compact(F.array(*phrases).cast("array<string>"))).alias("phrase"))
    found = lookup_join(grams, entries, "phrase", ["_rid"], "inner")
    applies = F.filter(
        "_entries",
        lambda e: (e["lang"] == ANY) | F.coalesce(e["lang"] == F.col("_lang"), F.lit(False)),
    )
    # A phrase listed for '*' and for the language counts once per category.
    categories = F.array_distinct(
        F.transform(applies, lambda e: F.struct(e["category_no"].alias("category_no"),
                                                e["category"].alias("category")))
    )
    per_category = (
        found.select("_rid", "phrase", F.explode(categories).alias("c"))
        .groupBy("_rid", "c.category_no", "c.category")
        .agg(F.count("*").cast("int").alias("n"), F.collect_set("phrase").alias("_phrases"))
    )
    per_text = per_category.groupBy("_rid").agg(
        F.array_sort(F.collect_list(F.struct("category_no", "category", "n"))).alias("policy_counts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_phrases")))).alias("policy_matched"),
    )
    return df.join(per_text, "_rid", "left").drop("_rid").withColumns(
        {
            "policy_counts": F.coalesce(
                F.col("policy_counts").cast(POLICY_COUNTS), F.array().cast(POLICY_COUNTS)
            ),
            "policy_matched": F.coalesce("policy_matched", F.array().cast("array<string>")),
        }
    )
