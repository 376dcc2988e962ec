"""Text scoring by lexicons, patterns and counts.

These are transparent stand-ins with the output shape of a hosted detector, not its model.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import defaults
from modspark import fixed_values as V
from modspark.functions import text as T
from modspark.operators.joins import BROADCAST_LIMIT, INLINE_LIMIT, column, is_small, rows_or_frame, salted_join
from modspark.operators.lexicons import ANY, count_hits
from modspark.operators.rows import compute_once, explode_rows

LANGUAGES_TYPE = "array<struct<lang:string,score:double>>"


def with_tokens(df: DataFrame, text: str | Column = "text", name: str = "_tokens") -> DataFrame:
    return compute_once(df, **{name: T.tokens(column(text))})


def detect_language(
    df: DataFrame,
    profiles: DataFrame | Iterable[tuple[str, str]] = tuple(defaults.LANGUAGE_PROFILES),
    text: str = "text",
    *,
    scripts: Sequence[tuple] = tuple(defaults.SCRIPT_PROFILES),
    id_col: str | None = None,
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add ``languages``: ranked (lang, score), best first; ``und`` when there is no evidence.

    score = hits of one language / hits of all.  Hits are words of the language's profile, and
    characters of its script for languages that ``scripts`` lists.
    """
    if isinstance(profiles, DataFrame):
        codes = [r[0] for r in profiles.select("lang").distinct().limit(INLINE_LIMIT + 1).collect()]
        if len(codes) > INLINE_LIMIT:
            raise ValueError(f"more than {INLINE_LIMIT} languages")
        lexicon = profiles.select(F.col("lang").alias("class"), "word", F.lit(ANY).alias("lang"))
    else:
        profiles = list(profiles)
        codes = sorted({lang for lang, _ in profiles})
        lexicon = [(lang, word, ANY) for lang, word in profiles]
    if set(codes) & {s[0] for s in scripts}:
        raise ValueError("a language has either a word profile or a script profile")
    counted = count_hits(
        with_tokens(df, text), lexicon, codes, lang=F.lit(ANY), id_col=id_col, prefix="_lang_",
        inline_limit=inline_limit, trie_limit=trie_limit,
    )
    evidence = {code: F.col(f"_lang_{code}") for code in codes}
    for code, chars, absent, present in scripts:
        # Pure ASCII has as many bytes as characters and needs no look at the script.
        allowed = (F.octet_length(text) > F.length(text)) & F.col(text).rlike(
            chars if present is None else present
        )
        if absent is not None:
            allowed = allowed & ~F.col(text).rlike(absent)
        evidence[code] = F.when(allowed, T.matching_chars(F.col(text), chars)).otherwise(0)
    # Sorting (-hits, lang) puts the best first and breaks ties by name.
    ranked = F.array_sort(
        F.filter(
            F.array(*[F.struct((-n).alias("minus"), F.lit(c).alias("lang")) for c, n in evidence.items()]),
            lambda e: e["minus"] < 0,
        )
    )
    total = F.aggregate("_ranked", F.lit(0), lambda acc, e: acc + e["minus"])
    scored = F.transform(
        "_ranked",
        lambda e: F.struct(e["lang"].alias("lang"), (e["minus"] / F.col("_total")).alias("score")),
    )
    undecided = F.array(F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score")))
    return (
        compute_once(compute_once(counted, _ranked=ranked), _total=total)
        .withColumn(
            "languages",
            F.when(F.size("_ranked") > 0, scored).otherwise(undecided).cast(LANGUAGES_TYPE),
        )
        .drop("_ranked", "_total", "_tokens", *[f"_lang_{c}" for c in codes])
    )


def resolve_english(
    df: DataFrame,
    translations: DataFrame | None = None,
    text: str = "text",
    lang: str = "lang",
    *,
    spread_by: Sequence[str] = (),
    salts: int = 16,
) -> DataFrame:
    """Add ``english`` and ``pending``.

    English text is taken as it is; other text is looked up in ``translations`` (text_hash =
    sha2(text, 256), english).  Without translation ``english`` is NULL and ``pending`` true.
    A text of unknown language is not English.
    """
    is_english = F.coalesce(F.col(lang) == "en", F.lit(False))
    if translations is None:
        return df.withColumns(
            {"english": F.when(is_english, F.col(text)), "pending": ~is_english}
        )
    lookup = translations.groupBy("text_hash").agg(F.max("english").alias("english"))
    if is_small(translations):
        # No shuffle: one pass, in which English rows have no hash and find nothing.
        found = df.withColumn("text_hash", F.when(~is_english, F.sha2(text, 256))).join(
            F.broadcast(lookup), "text_hash", "left"
        )
        english = F.when(is_english, F.col(text)).otherwise(F.col("english"))
        return (
            found.withColumn("english", english)
            .withColumn("pending", F.col("english").isNull() & ~is_english)
            .drop("text_hash")
        )
    # English rows and rows without text never meet the join, so they are not hashed or shuffled.
    looked_up = ~is_english & F.col(text).isNotNull()
    native = df.filter(~looked_up).withColumns(
        {"english": F.when(is_english, F.col(text)), "pending": ~is_english}
    )
    hashed = df.filter(looked_up).withColumn("text_hash", F.sha2(text, 256))
    foreign = salted_join(
        hashed, lookup, "text_hash", list(spread_by) or list(df.columns), "left", salts
    ).withColumn("pending", F.col("english").isNull())
    return native.unionByName(foreign.drop("text_hash"))


def sentiment(
    df: DataFrame,
    lexicon: DataFrame | Iterable[tuple[str, str, str]] = tuple(defaults.SENTIMENT_LEXICON),
    *,
    tokens: str = "_tokens",
    lang: str | Column = "lang",
    id_col: str | None = None,
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add ``sentiment`` and ``sentiment_score`` (four shares that sum to 1)."""
    counted = count_hits(
        df, lexicon, ["positive", "negative"], tokens=tokens, lang=lang, id_col=id_col,
        prefix="_s_", inline_limit=inline_limit, trie_limit=trie_limit,
    )
    p, n = F.col("_s_positive"), F.col("_s_negative")
    both = F.least(p, n)
    parts = {"POSITIVE": p - both, "NEGATIVE": n - both, "MIXED": 2 * both, "NEUTRAL": F.lit(1)}
    best = F.greatest(*parts.values())
    label = F
    for name in V.SENTIMENTS_BY_TIE_ORDER:
        label = label.when(parts[name] == best, F.lit(name))
    whole = (p + n + 1).cast("double")
    shares = F.struct(
        *[
            (parts[name.upper()] / whole).alias(name)
            for name in ("Positive", "Negative", "Neutral", "Mixed")
        ]
    )
    return counted.withColumns({"sentiment": label, "sentiment_score": shares}).drop(
        "_s_positive", "_s_negative"
    )


def with_pii(
    df: DataFrame,
    patterns: DataFrame | Iterable[tuple] = tuple(defaults.PII_PATTERNS),
    text: str = "text",
    name: str = "pii",
) -> DataFrame:
    """Add the array of personal-data entities (type, begin, end, score) of a text."""
    rows, frame = rows_or_frame(patterns, ["type", "pattern", "score"])
    if frame is not None:
        raise ValueError(f"more than {INLINE_LIMIT} patterns: join those of one type by |")
    return compute_once(df, **{name: F.expr(T.pii_sql(f"`{text}`", rows))})


def pii_entities(
    df: DataFrame,
    patterns: DataFrame | Iterable[tuple] = tuple(defaults.PII_PATTERNS),
    text: str = "text",
    ids: Sequence[str] = ("doc_id",),
    offset_basis: str = "source",
) -> DataFrame:
    """One row per entity; ``offset_basis`` names the text the offsets count in."""
    found = with_pii(df.select(*ids, F.col(text).alias("_t")), patterns, "_t")
    return explode_rows(found, ids, "pii", "e").select(
        *ids, "e.type", "e.begin", "e.end", "e.score", F.lit(offset_basis).alias("offset_basis")
    )


def toxicity(
    df: DataFrame,
    lexicon: DataFrame | Iterable[tuple[str, str, str]] = tuple(defaults.TOXICITY_LEXICON),
    *,
    tokens: str = "_tokens",
    lang: str | Column = "lang",
    id_col: str | None = None,
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Add ``toxicity_labels`` (category → score) and the overall ``toxicity``.

    A score is hits / (hits + 1); the overall score counts the hits of all categories.
    """
    counted = count_hits(
        df, lexicon, V.TOXICITY_CATEGORIES, tokens=tokens, lang=lang, id_col=id_col,
        prefix="_x_", inline_limit=inline_limit, trie_limit=trie_limit,
    )

    def share(n: Column) -> Column:
        return n / (n + F.lit(1.0))

    hits = {c: F.col(f"_x_{c}") for c in V.TOXICITY_CATEGORIES}
    total = sum(hits.values(), F.lit(0))
    labels = F.create_map(*[x for c, n in hits.items() for x in (F.lit(c), share(n))])
    return counted.withColumns({"toxicity_labels": labels, "toxicity": share(total)}).drop(
        *[f"_x_{c}" for c in hits]
    )
