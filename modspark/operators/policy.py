"""Policy rows, policy verdicts, prompts and the parsing of replies."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark import defaults
from modspark import fixed_values as V
from modspark.functions import text as T
from modspark.operators.joins import BROADCAST_LIMIT, INLINE_LIMIT, column, lookup_join, rows_or_frame
from modspark.operators.lexicons import ANY, POLICY_COUNTS, policy_hits
from modspark.operators.rows import compute_once

Policy = DataFrame | Iterable[tuple[int, str, str, str]]
Stems = Iterable[tuple[int, str, str, str]]


def load_policy(spark: SparkSession) -> DataFrame:
    """The default policy as rows (category_no, category, subcategory)."""
    rows = [(n, c, s) for n, (c, subs) in enumerate(V.POLICY, start=1) for s in subs]
    return spark.createDataFrame(rows, "category_no INT, category STRING, subcategory STRING")


def parse_policy(df: DataFrame, col: str = "policy") -> DataFrame:
    """Policy prose, one ``N. Category: it contains A, B and C.`` per line, to rows."""
    line = r"^\s*([0-9]+)\.\s*([^:]+):\s*(?:it contains)?(?:\s+contain)?\s*(.*?)\.?\s*$"
    each = df.select(F.explode(F.split(col, r"\R")).alias("l")).filter(F.col("l").rlike(line))
    return each.select(
        F.regexp_extract("l", line, 1).cast("int").alias("category_no"),
        F.regexp_extract("l", line, 2).alias("category"),
        F.explode(F.split(F.regexp_extract("l", line, 3), ", | and ")).alias("subcategory"),
    )


def policy_phrases(rows: DataFrame, lang: str = "en") -> DataFrame:
    """Policy rows to matchable phrases (category_no, category, phrase, lang)."""
    phrase = F.array_join(T.tokens(F.col("subcategory")), " ")
    return rows.select("category_no", "category", phrase.alias("phrase"), F.lit(lang).alias("lang"))


def policy_prose(policy: list[tuple[str, list[str]]] = V.POLICY) -> str:
    """The policy as numbered prose for prompts."""

    def listed(subs: list[str]) -> str:
        return subs[0] if len(subs) == 1 else f"{', '.join(subs[:-1])} and {subs[-1]}"

    return "\n".join(f"{n}. {c}: it contains {listed(subs)}." for n, (c, subs) in enumerate(policy, 1))


def with_stem_hits(
    df: DataFrame, stems: Stems = tuple(defaults.POLICY_STEMS), tokens: str = "_tokens", lang: str | Column = "lang"
) -> DataFrame:
    """Add the hits of word stems to ``policy_counts`` and ``policy_matched``.

    ``stems`` has (category_no, category, stem, lang), a list that is written into the plan.  A stem is
    found where a word begins with it; in languages of ``defaults.UNSPACED``, whose words run together,
    wherever it stands, longer stems first and without overlaps.  Texts are searched in place.
    """
    stems = [tuple(r) for r in stems]
    if not stems:
        return df
    lang = F.coalesce(column(lang).cast("string"), F.lit(""))
    names = {n: category for n, category, _, _ in stems}
    codes = sorted({code for *_, code in stems} - {ANY})
    listed = "array<string>"

    def found(number: int, code: str) -> Column:
        own = {stem for n, _, stem, c in stems if n == number and c in (ANY, code)}
        if not own:
            return F.array().cast(listed)
        any_of = "|".join(re.escape(stem) for stem in sorted(own, key=lambda stem: (-len(stem), stem)))
        # One blank before each word, so that a stem at the beginning of a word follows a blank.
        pattern = any_of if code in defaults.UNSPACED else f" (?:{any_of})"
        return F.regexp_extract_all("_words", F.lit(pattern), F.lit(0))

    def in_language(number: int) -> Column:
        chosen = found(number, ANY)
        for code in codes:
            chosen = F.when(F.col("_code") == code, found(number, code)).otherwise(chosen)
        return F.transform(chosen, lambda w: F.trim(w))

    words = F.concat(F.lit(" "), F.array_join(tokens, " "))
    ready = compute_once(df, _code=lang, _words=words)
    ready = compute_once(ready, **{f"_stems{n}": in_language(n) for n in names})
    all_names = F.array_distinct(F.concat(
        F.transform("policy_counts", lambda c: F.struct(c["category_no"].alias("category_no"), c["category"].alias("category"))),
        *[F.when(F.size(f"_stems{n}") > 0, F.array(F.struct(F.lit(n).alias("category_no"), F.lit(c).alias("category"))))
          .otherwise(F.array().cast("array<struct<category_no:int,category:string>>")) for n, c in sorted(names.items())],
    ))

    def total(c: Column) -> Column:
        phrases = F.aggregate(
            F.filter("policy_counts", lambda p: p["category_no"] == c["category_no"]), F.lit(0), lambda acc, p: acc + p["n"])
        return phrases + sum(
            (F.when(c["category_no"] == n, F.size(f"_stems{n}")).otherwise(0) for n in names), F.lit(0))

    counts = F.transform(F.array_sort(all_names), lambda c: F.struct(
        c["category_no"].alias("category_no"), c["category"].alias("category"), total(c).alias("n")))
    matched = F.array_sort(F.array_distinct(F.concat("policy_matched", *[F.col(f"_stems{n}") for n in names])))
    return ready.withColumns({"policy_counts": counts.cast(POLICY_COUNTS), "policy_matched": matched}).drop(
        "_code", "_words", *[f"_stems{n}" for n in names])


def with_judged(
    df: DataFrame, policy: Policy, stems: Stems = (), text: str | None = None, lang: str | Column = "lang",
    name: str = "judged", inline_limit: int = INLINE_LIMIT,
) -> DataFrame:
    """Add whether the policy says anything about texts of this language, and there is a text."""
    stem_codes = {code for *_, code in stems}
    codes = policy.select("lang") if isinstance(policy, DataFrame) else [(code,) for *_, code in policy]
    rows, frame = rows_or_frame(codes, ["lang"], inline_limit)
    present = F.lit(True) if text is None else F.col(text).isNotNull()
    lang = column(lang).cast("string")
    if rows is None:
        if ANY in stem_codes or frame.filter(F.col("lang") == ANY).limit(1).count():
            return df.withColumn(name, present)
        known = frame.groupBy(F.col("lang").alias("_code")).agg(F.lit(True).alias("_known"))
        spread = [text] if text else [c for c, t in df.dtypes if t in ("string", "bigint", "int")]
        joined = lookup_join(df.withColumn("_code", lang), known, "_code", spread)
        judged = present & (F.coalesce("_known", F.lit(False)) | F.coalesce(lang.isin(*stem_codes), F.lit(False)))
        return joined.withColumn(name, judged).drop("_code", "_known")
    every = {r[0] for r in rows if r[0] is not None} | stem_codes
    if ANY in every:
        return df.withColumn(name, present)
    return df.withColumn(name, present & F.coalesce(lang.isin(*sorted(every)), F.lit(False)))


def verdict_columns(counts: str = "policy_counts", matched: str = "policy_matched") -> dict[str, Column]:
    """flag, category (most hits, then policy order) and reason out of policy hits."""
    best = F.array_max(
        F.transform(
            counts,
            lambda c: F.struct(c["n"].alias("n"), (-c["category_no"]).alias("first"),
                               c["category"].alias("category")),
        )
    )
    return {
        "flag": F.size(counts) > 0,
        "category": F.coalesce(best["category"], F.lit("")),
        "reason": F.array_join(matched, ", "),
    }


def policy_verdict(
    df: DataFrame,
    policy: Policy = tuple(defaults.POLICY_PHRASES),
    *,
    tokens: str = "_tokens",
    lang: str | Column = "lang",
    id_col: str | None = None,
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
    stems: Stems = (),
    null_unjudged: str | bool = False,
) -> DataFrame:
    """Add flag, category and reason from policy phrases, and ``stems`` of words, in a text.

    With ``null_unjudged`` all three are NULL for a text in a language that the policy has no rows for;
    the name of a text column there makes missing texts unjudged as well.
    """
    df, stems, judged = _judging(df, policy, stems, lang, null_unjudged)
    hit = policy_hits(
        df, policy, tokens=tokens, lang=lang, id_col=id_col, inline_limit=inline_limit, trie_limit=trie_limit
    )
    hit = with_stem_hits(hit, stems, tokens, lang)
    return hit.withColumns(judged(verdict_columns())).drop("policy_counts", "policy_matched", "_judged")


def _judging(df, policy, stems, lang, null_unjudged):
    """The frame with ``_judged`` if asked for, the stems as a list, and what makes columns NULL elsewhere."""
    stems = list(stems)
    if not null_unjudged:
        return df, stems, lambda columns: columns
    text = null_unjudged if isinstance(null_unjudged, str) else None
    marked = with_judged(df, policy, stems, text, lang, "_judged")
    return marked, stems, lambda columns: {k: F.when(F.col("_judged"), c) for k, c in columns.items()}


def child_safety(
    df: DataFrame,
    policy: Policy = tuple(defaults.POLICY_PHRASES),
    *,
    tokens: str = "_tokens",
    lang: str | Column = "lang",
    id_col: str | None = None,
    thresholds: tuple[int, int, int] = (1, 3, 6),
    inline_limit: int = INLINE_LIMIT,
    trie_limit: int = BROADCAST_LIMIT,
    stems: Stems = (),
    null_unjudged: str | bool = False,
) -> DataFrame:
    """Add result (Safe/Unsafe), degree (None/Low/Med/High) and explanation; NULL as in ``policy_verdict``."""
    df, stems, judged = _judging(df, policy, stems, lang, null_unjudged)
    hit = policy_hits(
        df, policy, tokens=tokens, lang=lang, id_col=id_col, inline_limit=inline_limit, trie_limit=trie_limit
    )
    hit = with_stem_hits(hit, stems, tokens, lang)
    total = F.aggregate("policy_counts", F.lit(0), lambda acc, c: acc + c["n"])
    low, med, high = thresholds
    none_, low_, med_, high_ = V.DEGREES
    return (
        hit.withColumn("_n", total)
        .withColumns(judged(
            {
                "result": F.when(F.col("_n") > 0, V.RESULT_UNSAFE).otherwise(V.RESULT_SAFE),
                "degree": F.when(F.col("_n") >= high, high_)
                .when(F.col("_n") >= med, med_)
                .when(F.col("_n") >= low, low_)
                .otherwise(none_),
                "explanation": F.when(
                    F.col("_n") > 0,
                    F.concat(F.lit("found: "), F.array_join("policy_matched", ", ")),
                ).otherwise(F.lit("no policy phrase found")),
            }
        ))
        .drop("_n", "policy_counts", "policy_matched", "_judged")
    )


def render_prompts(
    df: DataFrame,
    template: str = V.JSON_VERDICT_TEMPLATE,
    policy: str | None = None,
    text: str = "text",
    name: str = "prompt",
) -> DataFrame:
    """Fill a prompt template per row; braces inside the text are left alone."""
    prose = policy_prose() if policy is None else policy
    parts: list[Column] = []
    for i, piece in enumerate(template.split("{text}")):
        if i:
            parts.append(F.col(text))
        parts.append(F.lit(piece.replace("{policy}", prose)))
    return df.withColumn(name, F.concat(*parts))


def parse_json_verdict(df: DataFrame, col: str) -> DataFrame:
    """Add flag, category, reason, parse_ok from a reply that should hold a JSON object."""
    return (
        df.withColumn("_v", T.json_verdict(F.col(col)))
        .select("*", "_v.flag", "_v.category", "_v.reason", "_v.parse_ok")
        .drop("_v")
    )


def parse_line_verdict(
    df: DataFrame, col: str, name: str = "verdict", unquote: bool = False
) -> DataFrame:
    """Add a map of the ``key:value`` lines of a reply."""
    return df.withColumn(name, T.line_verdict(F.col(col), unquote))
