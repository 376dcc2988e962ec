"""Records out of replies that a hosted detector gave: no scoring here, scores stay exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark import schemas
from modspark.functions import text as T


def dominant_language(df: DataFrame, col: str = "Languages", name: str = "lang") -> DataFrame:
    """Add the first language of a language reply, NULL without one."""
    return df.withColumn(name, F.get(F.col(col), F.lit(0))["LanguageCode"])


def first_class(df: DataFrame, col: str = "Classes") -> DataFrame:
    """Add ``prompt_class`` and its exact ``prompt_score`` from the first class of a reply."""
    first = F.get(F.col(col), F.lit(0))
    return df.withColumns({"prompt_class": first["Name"], "prompt_score": T.exact(first["Score"])})


def toxic_result(df: DataFrame, col: str = "ResultList") -> DataFrame:
    """Add ``toxicity`` and ``toxicity_labels`` (category → score), both exact, from the first result.

    Of a category that is listed twice the last score counts.
    """
    first = F.get(F.col(col), F.lit(0))
    labels = F.filter(first["Labels"], lambda x: x["Name"].isNotNull())
    last = F.filter(labels, lambda x, i: ~F.exists(
        F.slice(labels, i + 2, F.size(labels)), lambda later: later["Name"] == x["Name"]
    ))
    scores = F.map_from_entries(F.transform(last, lambda x: F.struct(x["Name"], T.exact(x["Score"]))))
    return df.withColumns({"toxicity": T.exact(first["Toxicity"]), "toxicity_labels": scores})


#: Reply kind → the column that holds it.
REPLY_COLUMNS = {
    "languages": "language_reply", "sentiment": "sentiment_reply", "pii": "pii_reply", "toxic_text": "toxic_reply",
    "classes": "class_reply",
}


def _parsed(df: DataFrame, kind: str, col: str) -> Column:
    return F.from_json(F.col(col), schemas.DETECTIONS[kind])


def analyze_replies(df: DataFrame, id_col: str = "doc_id", replies: dict[str, str] = REPLY_COLUMNS) -> DataFrame:
    """The analysis record of :func:`analyze_text` out of supplied JSON replies, one column per kind.

    ``lang``, ``sentiment``, ``sentiment_negative``, ``negative_score`` (0 if not negative), ``pii_type`` and
    ``pii_score`` of the first entity, ``toxicity``, ``toxicity_labels``, ``prompt_class``,
    ``prompt_score``; scores are exact decimals.  ``missing`` names the kinds whose reply is missing
    or cannot be read, in order: their fields are NULL and such a record must go to a person.  Kinds
    that ``replies`` leaves out are not in the record.  A reply is parsed once, no row is shuffled.
    """
    unknown = sorted(set(replies) - set(REPLY_COLUMNS))
    if unknown:
        raise ValueError(f"unknown kinds {unknown}; use {sorted(REPLY_COLUMNS)}")
    # A generated row cannot be copied into later expressions, so each reply is parsed once.
    row = F.struct(*[_parsed(df, kind, col).alias(f"_{kind}") for kind, col in replies.items()])
    parsed = df.select(F.col(id_col), F.inline_outer(F.array(row)))
    out: dict[str, Column] = {}
    answered: dict[str, Column] = {}
    if "languages" in replies:
        out["lang"] = F.get("_languages.Languages", F.lit(0))["LanguageCode"]
        answered["languages"] = out["lang"]
    if "sentiment" in replies:
        label = F.col("_sentiment.Sentiment")
        negative = label == "NEGATIVE"
        score = T.exact(F.col("_sentiment.SentimentScore.Negative"))
        out |= {"sentiment": label, "sentiment_negative": negative,
                "negative_score": F.when(negative, score).when(~negative, T.exact(F.lit(0.0)))}
        answered["sentiment"] = label
    if "pii" in replies:
        first = F.get("_pii.Entities", F.lit(0))
        out |= {"pii_type": first["Type"], "pii_score": T.exact(first["Score"])}
        answered["pii"] = F.col("_pii.Entities")
    kept = parsed.withColumns(out)
    if "toxic_text" in replies:
        kept = toxic_result(kept.withColumn("_r", F.col("_toxic_text.ResultList")), "_r").drop("_r")
        out |= dict.fromkeys(["toxicity", "toxicity_labels"], F.lit(None))
        answered["toxic_text"] = F.get("_toxic_text.ResultList", F.lit(0))
    if "classes" in replies:
        kept = first_class(kept.withColumn("_c", F.col("_classes.Classes")), "_c").drop("_c")
        out |= dict.fromkeys(["prompt_class", "prompt_score"], F.lit(None))
        answered["classes"] = F.get("_classes.Classes", F.lit(0))
    missing = F.filter(F.array(*[F.when(c.isNull(), F.lit(k)) for k, c in answered.items()]), lambda k: k.isNotNull())
    return kept.withColumn("missing", missing).select(id_col, *out, "missing")
