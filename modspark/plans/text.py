"""Text plans: moderation result, analysis record, safety record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import defaults
from modspark.operators import policy as P
from modspark.operators import scoring as S
from modspark.operators.classifier import ClassifierModel, PromptScorer
from modspark.operators.joins import INLINE_LIMIT
from modspark.operators.routing import negative_flag
from modspark.operators.rows import with_row_id
from modspark.operators.select import first_pii, top_language


def with_language(
    df: DataFrame, text: str = "text", lang: str | None = None, name: str = "lang",
    profiles=tuple(defaults.LANGUAGE_PROFILES), id_col: str | None = None,
) -> DataFrame:
    """``name`` = the given language column, or the top of the language ranking."""
    if lang is not None:
        return df if lang == name else df.withColumn(name, F.col(lang))
    ranked = S.detect_language(df, profiles, text, id_col=id_col)
    return top_language(ranked, name=name).drop("languages")


def moderate_text(
    df: DataFrame,
    text: str = "text",
    lang: str | None = None,
    *,
    translations: DataFrame | None = None,
    policy: P.Policy = tuple(defaults.POLICY_PHRASES),
    lexicon: DataFrame | Iterable = tuple(defaults.SENTIMENT_LEXICON),
    patterns: DataFrame | Iterable = tuple(defaults.PII_PATTERNS),
    profiles: DataFrame | Iterable = tuple(defaults.LANGUAGE_PROFILES),
    id_col: str | None = None,
    inline_limit: int = INLINE_LIMIT,
    stems: P.Stems = (),
    null_unjudged: bool = False,
) -> DataFrame:
    """Language, English text, policy verdict, sentiment and personal data per text.

    Adds lang, pending, offset_basis, flag, category, reason, sentiment, sentiment_score, pii.
    Language and translation are found once.  A text without translation is scored as it is, with
    the lexicon rows of its own language; with ``null_unjudged`` its verdict is NULL where the policy
    has no rows or ``stems`` for that language, or there is no text.  With lexicons of normal size this is a single pass over
    the rows: no shuffle unless ``translations`` has to be joined.
    """
    known = with_language(df, text, lang, "lang", profiles, id_col)
    english = S.resolve_english(
        known, translations, text, "lang", spread_by=[id_col] if id_col else ()
    )
    scored = (
        english.withColumn("offset_basis", F.when(F.col("pending") | (F.col("lang") == "en"), "source")
                           .otherwise("english"))
        .withColumn("_scored", F.coalesce("english", text))
        .withColumn("_lang", F.when(F.col("pending"), F.col("lang")).otherwise(F.lit("en")))
    )
    scored = S.with_tokens(scored, "_scored")
    scored = P.policy_verdict(scored, policy, lang="_lang", id_col=id_col, inline_limit=inline_limit, stems=stems,
                              null_unjudged="_scored" if null_unjudged else False)
    scored = S.sentiment(scored, lexicon, lang="_lang", id_col=id_col, inline_limit=inline_limit)
    scored = S.with_pii(scored, patterns, "_scored")
    return scored.drop("_tokens", "_scored", "_lang", "english")


def text_result(text: str | Column | None = "text") -> Column:
    """The nested text result out of the columns of :func:`moderate_text`; NULL for no text."""
    fields = [
        F.struct("flag", "category", "reason").alias("verdict"),
        F.struct("sentiment", "sentiment_score", "pii", "offset_basis", "pending").alias("analysis"),
    ]
    if text is None:
        return F.struct(*fields)
    value = F.col(text) if isinstance(text, str) else text
    return F.when(value.isNotNull(), F.struct(value.alias("text"), *fields))


def analyze_text(
    df: DataFrame,
    model: ClassifierModel,
    text: str = "text",
    lang: str | None = None,
    id_col: str = "doc_id",
    *,
    translations: DataFrame | None = None,
    lexicon: DataFrame | Iterable = tuple(defaults.SENTIMENT_LEXICON),
    toxic_lexicon: DataFrame | Iterable = tuple(defaults.TOXICITY_LEXICON),
    patterns: DataFrame | Iterable = tuple(defaults.PII_PATTERNS),
) -> DataFrame:
    """Record per text: negative flag and score, first entity, toxicity, prompt safety."""
    known = with_language(df, text, lang, "lang", id_col=id_col)
    english = S.resolve_english(known, translations, text, "lang", spread_by=[id_col])
    scored = (
        english.withColumn("_scored", F.coalesce("english", text))
        .withColumn("_lang", F.when(F.col("pending"), F.col("lang")).otherwise(F.lit("en")))
    )
    scorer = PromptScorer(model)
    if scorer.small:  # everything in one pass over the rows
        scored = scorer.with_sums(S.with_tokens(scored, "_scored"), F.col("_tokens"))
        sums = None
    else:
        # The words for the model branch off before any score, so nothing is scored twice.
        keyed = with_row_id(scored)
        sums = scorer.word_sums(keyed.select("_rid", "_scored"), "_scored")
        scored = S.with_tokens(keyed, "_scored")
    scored = S.sentiment(scored, lexicon, lang="_lang", id_col=id_col)
    scored = S.toxicity(scored, toxic_lexicon, lang="_lang", id_col=id_col)
    scored = first_pii(S.with_pii(negative_flag(scored), patterns, "_scored"))
    kept = [
        id_col, "lang", "pending", "sentiment", "sentiment_negative", "negative_score", "pii_type", "pii_score", "toxicity",
        "toxicity_labels",
    ]
    if sums is None:
        return scorer.with_class(scored.select(*kept, "_n", *scorer.gain.values()))
    # Scores and word sums meet by row, without the text.
    return scorer.with_class(scored.select("_rid", *kept).join(sums, "_rid", "left")).drop("_rid")


def safety_record(
    df: DataFrame,
    key: str = "doc_id",
    replies: str | None = None,
    text: str = "text",
    lang: str = "lang",
    policy: P.Policy = tuple(defaults.POLICY_PHRASES),
    unquote: bool = True,
    stems: P.Stems = (),
    null_unjudged: bool = False,
) -> DataFrame:
    """Keyed record (key, result, degree, explanation).

    From the policy phrases and ``stems`` (NULL for what they cannot judge, with ``null_unjudged``), or from supplied ``key:value`` replies when ``replies`` names a column.
    """
    if replies is not None:
        parsed = P.parse_line_verdict(df, replies, "_v", unquote)
        return parsed.select(
            key,
            F.col("_v")["Result"].alias("result"),
            F.col("_v")["Degree of harm"].alias("degree"),
            F.col("_v")["Explanation"].alias("explanation"),
        )
    scored = P.child_safety(S.with_tokens(df, text), policy, lang=lang, id_col=key, stems=stems,
                            null_unjudged=text if null_unjudged else False)
    return scored.select(key, "result", "degree", "explanation")
