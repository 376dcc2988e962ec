"""Queries over texts: scoring, verdicts, records."""

from __future__ import annotations


from pyspark.sql import functions as F

import modspark as m
from modspark import fixed_values as V
from modspark.defaults import POLICY_STEMS, phrase_of
from modspark.operators.classifier import PromptScorer
from modspark.operators.lexicons import policy_hits
from modspark.operators.policy import policy_prose
from modspark.operators.rows import explode_rows, with_row_id
from modspark.scratch import scratch_folder
from workload import builders as B
from workload import tables as X
from workload.registry import TOKENS, query, values
from workload.tables import load, spread_files

DOCS = "documents"


def docs(spark, sf):
    return load(spark, sf, DOCS, spread="doc_id").select("doc_id", "text", "lang")


def tokens(spark, sf):
    return m.with_tokens(docs(spark, sf))


# --- language -----------------------------------------------------------------------------------

RANKING = f"""
ranking AS (
  SELECT doc_id, lang, n, n / sum(n) OVER (PARTITION BY doc_id) AS score,
         row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) AS rank
  FROM (SELECT doc_id, p.lang, count(*) AS n
        FROM (SELECT doc_id, unnest({TOKENS}) AS word FROM documents) w
        JOIN (SELECT * FROM {values(X.PROFILES, 'lang, word')}) p USING (word)
        GROUP BY ALL)
)"""


@query(
    "detect_language",
    f"""WITH {RANKING}
    SELECT doc_id, coalesce(r.lang, 'und') AS top_lang,
           coalesce(round(r.score, 6), 0.0)::double AS top_score,
           coalesce(a.ranked, 'und') AS ranked
    FROM documents LEFT JOIN (SELECT * FROM ranking WHERE rank = 1) r USING (doc_id)
    LEFT JOIN (SELECT doc_id, string_agg(lang, ',' ORDER BY rank) AS ranked FROM ranking GROUP BY 1) a
      USING (doc_id)""",
)
def detect_language(spark, sf):
    ranked = m.detect_language(docs(spark, sf), X.PROFILES)
    first = F.get("languages", F.lit(0))
    return ranked.select(
        "doc_id",
        first["lang"].alias("top_lang"),
        F.round(first["score"], 6).alias("top_score"),
        F.array_join(F.transform("languages", lambda l: l["lang"]), ",").alias("ranked"),
    )


@query(
    "top_language",
    f"""WITH {RANKING}
    SELECT doc_id, CASE WHEN r.score >= 0.5 THEN r.lang ELSE 'und' END AS lang
    FROM documents LEFT JOIN (SELECT * FROM ranking WHERE rank = 1) r USING (doc_id)""",
)
def top_language(spark, sf):
    ranked = m.detect_language(docs(spark, sf).drop("lang"), X.PROFILES)
    return m.top_language(ranked, min_score=0.5).select("doc_id", "lang")


@query("needs_translation", "SELECT doc_id, lang FROM documents WHERE lang IS DISTINCT FROM 'en'")
def needs_translation(spark, sf):
    return m.needs_translation(load(spark, sf, DOCS)).select("doc_id", "lang")


@query(
    "has_text",
    "SELECT doc_id, length(text)::int AS n FROM documents WHERE length(text) > 0",
)
def has_text(spark, sf):
    return m.has_text(load(spark, sf, DOCS)).select("doc_id", F.length("text").alias("n"))


def translations(spark, sf):
    """Supplied translations, keyed by text: those of web texts (invented as ``en: <hash>``)."""
    d = load(spark, sf, DOCS)
    h = F.sha2("text", 256)
    return d.filter((F.col("lang") != "en") & (F.col("source") == "web")).select(
        h.alias("text_hash"), F.concat(F.lit("en: "), h).alias("english")
    )


TRANSLATED = """
translated AS (SELECT DISTINCT text AS t FROM documents WHERE lang <> 'en' AND source = 'web')"""


@query(
    "resolve_english",
    f"""WITH {TRANSLATED}
    SELECT doc_id, lang <> 'en' AND t IS NULL AS pending,
           md5(CASE WHEN lang = 'en' THEN text WHEN t IS NOT NULL THEN 'en: ' || sha256(text) END) AS english_md5
    FROM documents LEFT JOIN translated ON lang <> 'en' AND text = t""",
)
def resolve_english(spark, sf):
    r = m.resolve_english(docs(spark, sf), translations(spark, sf), spread_by=["doc_id"])
    return r.select("doc_id", "pending", F.md5("english").alias("english_md5"))


# --- sentiment, toxicity ------------------------------------------------------------------------


def hit_counts(lexicon, name):
    return f"""{name} AS (
      SELECT doc_id, class, count(*) AS n
      FROM (SELECT doc_id, lang AS dl, unnest({TOKENS}) AS word FROM documents) w
      JOIN (SELECT * FROM {values(lexicon, 'class, word, lang')}) l
        ON w.word = l.word AND (l.lang = '*' OR l.lang = w.dl)
      GROUP BY ALL)"""


SENTIMENT = f"""{hit_counts(X.SENTIMENTS, 'sh')},
pn AS (SELECT d.doc_id, coalesce(max(n) FILTER (class = 'positive'), 0) AS p,
              coalesce(max(n) FILTER (class = 'negative'), 0) AS n
       FROM documents d LEFT JOIN sh USING (doc_id) GROUP BY 1),
sent AS (
  SELECT doc_id,
    CASE WHEN n - least(p, n) = g THEN 'NEGATIVE' WHEN p - least(p, n) = g THEN 'POSITIVE'
         WHEN 2 * least(p, n) = g THEN 'MIXED' ELSE 'NEUTRAL' END AS sentiment,
    round((p - least(p, n)) / (p + n + 1), 6) AS positive,
    round((n - least(p, n)) / (p + n + 1), 6) AS negative,
    round(1 / (p + n + 1), 6) AS neutral,
    round(2 * least(p, n) / (p + n + 1), 6) AS mixed
  FROM (SELECT *, greatest(p - least(p, n), n - least(p, n), 2 * least(p, n), 1) AS g FROM pn))"""


def sentiments(spark, sf):
    return m.sentiment(tokens(spark, sf), X.SENTIMENTS)


@query("sentiment", f"WITH {SENTIMENT} SELECT * FROM sent")
def sentiment(spark, sf):
    s = sentiments(spark, sf)
    return s.select(
        "doc_id", "sentiment",
        *[F.round(f"sentiment_score.{c}", 6).alias(c.lower())
          for c in ("Positive", "Negative", "Neutral", "Mixed")],
    )


@query(
    "negative_flag",
    f"""WITH {SENTIMENT}
    SELECT doc_id, sentiment = 'NEGATIVE' AS sentiment_negative,
           CASE WHEN sentiment = 'NEGATIVE' THEN negative ELSE 0.0 END AS negative_score FROM sent""",
)
def negative_flag(spark, sf):
    return m.negative_flag(sentiments(spark, sf)).select(
        "doc_id", "sentiment_negative", F.round("negative_score", 6).alias("negative_score")
    )


TOX = f"""{hit_counts(X.TOXIC, 'th')},
tox AS (SELECT d.doc_id, {', '.join(
    f"coalesce(max(n) FILTER (class = '{c}'), 0) AS {c}" for c in V.TOXICITY_CATEGORIES)},
    coalesce(sum(n), 0) AS total
  FROM documents d LEFT JOIN th USING (doc_id) GROUP BY 1)"""


@query(
    "toxicity",
    f"""WITH {TOX} SELECT doc_id, round(total / (total + 1), 6)::double AS toxicity,
    {', '.join(f'round({c} / ({c} + 1), 6)::double AS {c}' for c in V.TOXICITY_CATEGORIES)} FROM tox""",
)
def toxicity(spark, sf):
    t = m.toxicity(tokens(spark, sf), X.TOXIC)
    return t.select(
        "doc_id", F.round("toxicity", 6).alias("toxicity"),
        *[F.round(F.col("toxicity_labels")[c], 6).alias(c) for c in V.TOXICITY_CATEGORIES],
    )


# --- personal data ------------------------------------------------------------------------------

# The checking patterns carry their borders in the match (groups 1 and 3), because the checker has
# no look-around.
SQL_PATTERNS = [
    ("EMAIL", r"()([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})()"),
    ("PHONE", r"(^|[^0-9+])(\+[0-9]{1,3}(?: {3})?\([0-9]{3}\)(?: {3})?[0-9]{3}-[0-9]{4}|1[0-9]{10})($|[^0-9])"),
    ("IP_ADDRESS", r"(^|[^0-9.])([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})($|[^0-9])"),
    ("CREDIT_DEBIT_NUMBER", r"(^|[^0-9])([0-9]{16})($|[^0-9])"),
]


def pii_sql(table: str, ids: str, text: str = "text") -> str:
    """Every entity with its offsets.  Each blank and line break is tripled first, so that two
    entities with one blank between them keep a border each; offsets are counted back."""
    parts = []
    for kind, pattern in SQL_PATTERNS:
        p = pattern.replace("'", "''")
        parts.append(f"""
      SELECT {ids}, '{kind}' AS type, t,
             unnest(regexp_extract_all(t, '{p}', 0)) AS whole, unnest(regexp_extract_all(t, '{p}', 1)) AS b,
             unnest(list_transform(regexp_extract_all(t, '{p}', 2), lambda s: replace(s, '   ', ' '))) AS v,
             unnest(list_transform(range(1, len(string_split_regex(t, '{p}'))),
               lambda i: list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda s: length(s))))) AS pieces,
             unnest(range(1, len(string_split_regex(t, '{p}')))) AS k
      FROM (SELECT {ids}, replace(replace({text}, ' ', '   '), chr(10), chr(10) || chr(10) || chr(10)) AS t FROM {table})""")
    union = " UNION ALL ".join(parts)
    return f"""(
  SELECT {ids}, type, begin_, begin_ + length(v) AS end_, v FROM (
    SELECT *, length(t[1:upto]) - 2 * ((length(t[1:upto]) - length(replace(replace(t[1:upto], ' ', ''), chr(10), ''))) // 3) AS begin_
    FROM (SELECT *, (pieces + coalesce(sum(length(whole)) OVER
              (PARTITION BY {ids}, type ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + length(b))::bigint AS upto
          FROM ({union}))))"""


PII = pii_sql("documents", "doc_id")


@query(
    "pii_entities",
    f"""SELECT doc_id, type, begin_::int AS begin_offset, end_::int AS end_offset, v AS found
    FROM {PII}""",
)
def pii_entities(spark, sf):
    d = docs(spark, sf).withColumn("copy", F.col("text"))
    e = m.pii_entities(d, ids=["doc_id", "copy"])
    return e.select(
        "doc_id", "type", F.col("begin").alias("begin_offset"), F.col("end").alias("end_offset"),
        F.col("copy").substr(F.col("begin") + 1, F.col("end") - F.col("begin")).alias("found"),
    )


FIRST_PII = f"""first AS (
  SELECT doc_id, type AS pii_type, n FROM (
    SELECT *, count(*) OVER (PARTITION BY doc_id) AS n,
           row_number() OVER (PARTITION BY doc_id ORDER BY begin_, end_, type) AS r FROM {PII}) WHERE r = 1)"""


@query(
    "first_pii",
    f"""WITH {FIRST_PII} SELECT doc_id, pii_type, CASE WHEN pii_type IS NOT NULL THEN 1.0::double END AS pii_score
    FROM documents LEFT JOIN first USING (doc_id)""",
)
def first_pii(spark, sf):
    return m.first_pii(m.with_pii(docs(spark, sf))).select("doc_id", "pii_type", "pii_score")


# --- policy -------------------------------------------------------------------------------------

GRAMS = f"""
words AS (
  SELECT doc_id, lang AS dl, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i
  FROM (SELECT doc_id, lang, {TOKENS} AS w FROM documents)),
runs AS (
  SELECT doc_id, dl, w, lead(w, 1) OVER o AS x, lead(w, 2) OVER o AS y, lead(w, 3) OVER o AS z
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
grams AS (
  SELECT doc_id, dl, w AS phrase FROM runs
  UNION ALL SELECT doc_id, dl, w || ' ' || x FROM runs WHERE x IS NOT NULL
  UNION ALL SELECT doc_id, dl, w || ' ' || x || ' ' || y FROM runs WHERE y IS NOT NULL
  UNION ALL SELECT doc_id, dl, w || ' ' || x || ' ' || y || ' ' || z FROM runs WHERE z IS NOT NULL),"""

POLICY = f"""
{GRAMS}
ph AS (
  SELECT doc_id, category_no, category, phrase, count(*) AS n
  FROM grams JOIN (SELECT * FROM {values(X.PHRASES, 'category_no, category, phrase, lang')}) p USING (phrase)
  WHERE p.lang = '*' OR p.lang = dl GROUP BY ALL),
per_category AS (SELECT doc_id, category_no, category, sum(n) AS n FROM ph GROUP BY ALL),
verdict AS (
  SELECT d.doc_id, c.category IS NOT NULL AS flag, coalesce(c.category, '') AS category,
         coalesce(r.reason, '') AS reason, coalesce(r.hits, 0) AS hits
  FROM documents d
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, category_no) AS k
             FROM per_category) c ON d.doc_id = c.doc_id AND k = 1
  LEFT JOIN (SELECT doc_id, string_agg(DISTINCT phrase, ', ' ORDER BY phrase) AS reason, sum(n) AS hits
             FROM ph GROUP BY 1) r ON d.doc_id = r.doc_id)"""


@query("policy_verdict", f"WITH {POLICY} SELECT doc_id, flag, category, reason FROM verdict")
def policy_verdict(spark, sf):
    v = m.policy_verdict(tokens(spark, sf), X.PHRASES)
    return v.select("doc_id", "flag", "category", "reason")


# Titles and word stems of two languages; texts in others cannot be judged and go to review.
JUDGED = ("en", "fr")
PROSE_PHRASES = [r for r in X.PHRASES if r[3] in JUDGED]
PROSE_STEMS = [
    *[r for r in POLICY_STEMS if r[3] in JUDGED],
    (3, "Violence", "hes", "en"), (3, "Violence", "heshe", "en"), (6, "Drugs", "oui", "fr"), (9, "Gambling", "stup", "en"),
]
PROSE = f"""
{GRAMS}
stem_hits AS (
  SELECT doc_id, i, category_no, category, stem, row_number() OVER (
    PARTITION BY doc_id, i, category_no ORDER BY length(stem) DESC, stem) AS k
  FROM words JOIN (SELECT * FROM {values(PROSE_STEMS, 'category_no, category, stem, lang')}) s
    ON starts_with(w, stem) AND s.lang = dl),
ph AS (
  SELECT doc_id, category_no, category, phrase AS found
  FROM grams JOIN (SELECT * FROM {values(PROSE_PHRASES, 'category_no, category, phrase, lang')}) p USING (phrase)
  WHERE p.lang = dl
  UNION ALL SELECT doc_id, category_no, category, stem FROM stem_hits WHERE k = 1),
best AS (
  SELECT doc_id, category, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, category_no) AS k
  FROM ph GROUP BY doc_id, category_no, category),
reasons AS (
  SELECT doc_id, count(*) AS hits, string_agg(DISTINCT found, ', ' ORDER BY found) AS reason FROM ph GROUP BY 1),
judged AS (SELECT doc_id FROM documents WHERE text IS NOT NULL AND lang IN ('en', 'fr'))"""


@query(
    "policy_prose",
    f"""WITH {PROSE}
    SELECT d.doc_id, CASE WHEN j.doc_id IS NOT NULL THEN (hits IS NOT NULL)::varchar END AS flag,
      CASE WHEN j.doc_id IS NOT NULL THEN coalesce(category, '') END AS category,
      CASE WHEN j.doc_id IS NOT NULL THEN coalesce(reason, '') END AS reason,
      CASE WHEN j.doc_id IS NOT NULL AND hits IS NULL THEN '{V.DECISION_PASS}' ELSE '{V.DECISION_REVIEW}' END AS decision
    FROM documents d LEFT JOIN judged j USING (doc_id) LEFT JOIN reasons USING (doc_id)
    LEFT JOIN (SELECT * FROM best WHERE k = 1) USING (doc_id)""",
)
def policy_prose_verdict(spark, sf):
    """Phrases and word stems in prose; NULL, and review, for what the policy cannot judge."""
    v = m.policy_verdict(tokens(spark, sf), PROSE_PHRASES, stems=PROSE_STEMS, null_unjudged="text")
    return m.flag_decision(v).select("doc_id", F.col("flag").cast("string").alias("flag"), "category", "reason", "decision")


@query(
    "safety_record_prose",
    f"""WITH {PROSE}
    SELECT 'doc/' || d.doc_id AS key,
      CASE WHEN j.doc_id IS NOT NULL THEN CASE WHEN hits > 0 THEN 'Unsafe' ELSE 'Safe' END END AS result,
      CASE WHEN j.doc_id IS NOT NULL THEN CASE WHEN hits >= 6 THEN 'High' WHEN hits >= 3 THEN 'Med'
        WHEN hits >= 1 THEN 'Low' ELSE 'None' END END AS degree,
      CASE WHEN j.doc_id IS NOT NULL THEN coalesce('found: ' || reason, 'no policy phrase found') END AS explanation
    FROM documents d LEFT JOIN judged j USING (doc_id) LEFT JOIN reasons USING (doc_id)""",
)
def safety_record_prose(spark, sf):
    d = docs(spark, sf).withColumn("key", F.concat(F.lit("doc/"), "doc_id"))
    return m.safety_record(d, "key", policy=PROSE_PHRASES, stems=PROSE_STEMS, null_unjudged=True)


SAFETY = f"""{POLICY},
safety AS (SELECT doc_id, CASE WHEN hits > 0 THEN 'Unsafe' ELSE 'Safe' END AS result,
    CASE WHEN hits >= 6 THEN 'High' WHEN hits >= 3 THEN 'Med' WHEN hits >= 1 THEN 'Low' ELSE 'None' END AS degree,
    CASE WHEN hits > 0 THEN 'found: ' || reason ELSE 'no policy phrase found' END AS explanation
  FROM verdict)"""


@query("child_safety", f"WITH {SAFETY} SELECT * FROM safety")
def child_safety(spark, sf):
    v = m.child_safety(tokens(spark, sf), X.PHRASES)
    return v.select("doc_id", "result", "degree", "explanation")


@query("safety_record", f"WITH {SAFETY} SELECT 'doc/' || doc_id AS key, result, degree, explanation FROM safety")
def safety_record(spark, sf):
    d = docs(spark, sf).withColumn("key", F.concat(F.lit("doc/"), "doc_id"))
    return m.safety_record(d, "key", policy=X.PHRASES)


@query(
    "safety_record_of_replies",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN 'Unsafe' ELSE 'Safe' END AS result,
              CASE WHEN toxic = 1 THEN 'High' ELSE 'None' END AS degree, NULL::varchar AS explanation
       FROM labels""",
)
def safety_record_of_replies(spark, sf):
    return m.safety_record(B.verdict_texts(spark, sf), replies="line_reply")


@query(
    "policy_rows",
    f"""WITH {GRAMS.strip().rstrip(',')}, p AS (SELECT * FROM {values(
        [(n, c, s) for n, (c, subs) in enumerate(V.POLICY, 1) for s in subs], 'category_no, category, subcategory')})
    SELECT category_no, category, subcategory, count(DISTINCT doc_id)::bigint AS documents
    FROM p LEFT JOIN grams ON lower(subcategory) = phrase
    GROUP BY ALL""",
)
def policy_rows(spark, sf):
    """The policy with the number of documents that mention each subcategory."""
    rows = [
        (i, r["category_no"], r["category"], r["subcategory"])
        for i, r in enumerate(m.load_policy(spark).collect())
    ]
    # Every subcategory is counted as a category of its own.
    phrases = [(i, str(i), phrase_of(sub), "*") for i, _, _, sub in rows]
    each = explode_rows(
        policy_hits(tokens(spark, sf), phrases), [], F.col("policy_counts.category_no"), "i"
    )
    counts = each.groupBy("i").agg(F.count("*").alias("documents"))
    policy = spark.createDataFrame(rows, "i INT, category_no INT, category STRING, subcategory STRING")
    return policy.join(counts, "i", "left").select(
        "category_no", "category", "subcategory",
        F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents"),
    )


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _prompt_sql(template: str) -> str:
    before, after = template.replace("{policy}", policy_prose()).split("{text}")
    return f"md5({_sql_text(before)} || text || {_sql_text(after)})"


@query(
    "render_prompts",
    f"""SELECT doc_id, {_prompt_sql(V.JSON_VERDICT_TEMPLATE)} AS json_prompt,
               {_prompt_sql(V.LINE_VERDICT_TEMPLATE)} AS line_prompt FROM documents""",
)
def render_prompts(spark, sf):
    one = m.render_prompts(docs(spark, sf), V.JSON_VERDICT_TEMPLATE, name="a")
    two = m.render_prompts(one, V.LINE_VERDICT_TEMPLATE, name="b")
    return two.select("doc_id", F.md5("a").alias("json_prompt"), F.md5("b").alias("line_prompt"))


@query(
    "parse_json_verdict",
    """SELECT doc_id, quality <> 0 OR toxic <> 0 AS parse_ok,
       CASE WHEN quality <> 0 OR toxic <> 0 THEN toxic = 1 END::varchar AS flag,
       CASE WHEN toxic = 1 THEN 'Hate Symbols' WHEN quality <> 0 THEN '' END AS category,
       CASE WHEN quality <> 0 OR toxic <> 0 THEN 'the reason' || chr(10) || 'is ' || quality END AS reason
       FROM labels""",
)
def parse_json_verdict(spark, sf):
    v = m.parse_json_verdict(B.verdict_texts(spark, sf), "json_reply")
    return v.select("doc_id", "parse_ok", F.col("flag").cast("string").alias("flag"), "category", "reason")


@query(
    "parse_line_verdict",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN '"Unsafe"' ELSE '"Safe"' END AS result,
       CASE WHEN toxic = 1 THEN '"High"' ELSE '"None"' END AS degree, quality::varchar AS quality_line,
       3 AS n_lines FROM labels""",
)
def parse_line_verdict(spark, sf):
    v = m.parse_line_verdict(B.verdict_texts(spark, sf), "line_reply")
    x = F.col("verdict")
    return v.select(
        "doc_id", x["Result"].alias("result"), x["Degree of harm"].alias("degree"),
        x["Quality"].alias("quality_line"), F.size("verdict").alias("n_lines"),
    )


# --- classifier ---------------------------------------------------------------------------------

MODEL = f"""
lw AS (SELECT toxic::varchar AS class, unnest({TOKENS}) AS word FROM labels JOIN documents USING (doc_id)),
wc AS (SELECT class, word, count(*) AS n FROM lw GROUP BY ALL),
cls AS (SELECT class, n_docs, n_words FROM (SELECT toxic::varchar AS class, count(*) AS n_docs
           FROM labels JOIN documents USING (doc_id) GROUP BY 1)
        JOIN (SELECT class, count(*) AS n_words FROM lw GROUP BY 1) USING (class)),
vs AS (SELECT count(DISTINCT word) AS v, (SELECT sum(n_docs) FROM cls) AS nd FROM wc),
tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS word FROM documents)
       WHERE word IN (SELECT word FROM wc) GROUP BY ALL),
total AS (SELECT doc_id, sum(tf) AS t FROM tf GROUP BY 1),
gain AS (SELECT doc_id, class, sum(tf * ln(n + 1.0)) AS g FROM tf JOIN wc USING (word) GROUP BY ALL),
score AS (SELECT d.doc_id, cls.class,
    round(ln(n_docs / nd::double) + coalesce(g, 0) - coalesce(t, 0) * ln((n_words + v)::double), 4) AS s
  FROM documents d CROSS JOIN cls CROSS JOIN vs LEFT JOIN total USING (doc_id)
  LEFT JOIN gain ON gain.doc_id = d.doc_id AND gain.class = cls.class),
prompt AS (
  SELECT doc_id, arg_max(class, (s, class)) AS prompt_class, max(s) AS prompt_log_score,
         round(1 / sum(exp(s - m)), 4) AS prompt_score
  FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS m FROM score) GROUP BY 1)"""


def labelled(spark, sf):
    labels = load(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return labels.join(docs(spark, sf).drop("lang"), "doc_id")


def model(spark, sf):
    return m.fit_classifier(labelled(spark, sf), save_to=scratch_folder(spark, "classifier"))


@query(
    "classifier_model",
    f"WITH {MODEL} SELECT class, word, n::bigint AS n, n_docs::bigint AS n_docs, n_words::bigint AS n_words FROM wc JOIN cls USING (class)",
)
def classifier_model(spark, sf):
    fitted = m.fit_classifier(labelled(spark, sf))
    return fitted.words.join(fitted.classes, "class").select("class", "word", "n", "n_docs", "n_words")


@query("prompt_safety", f"WITH {MODEL} SELECT * FROM prompt")
def prompt_safety(spark, sf):
    p = m.prompt_safety(docs(spark, sf).select("doc_id", "text"), model(spark, sf))
    return p.select("doc_id", "prompt_class", F.round("prompt_score", 4).alias("prompt_score"), "prompt_log_score")


# --- rows whose ids repeat or are missing -------------------------------------------------------


def thrice(df):
    """Every row with its id, with its id again, and without id."""
    return df.unionByName(df).unionByName(df.withColumn("doc_id", F.lit(None).cast("bigint")))


def thrice_sql(columns: str, table: str) -> str:
    return (f"SELECT doc_id, {columns} FROM {table} UNION ALL SELECT doc_id, {columns} FROM {table} "
            f"UNION ALL SELECT -1, {columns} FROM {table}")


def shown_id(df):
    return df.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))


@query("policy_verdict_by_join", f"WITH {POLICY} {thrice_sql('flag, category, reason', 'verdict')}")
def policy_verdict_by_join(spark, sf):
    v = m.policy_verdict(thrice(tokens(spark, sf)), X.PHRASES, inline_limit=0, trie_limit=0)
    return shown_id(v).select("doc_id", "flag", "category", "reason")


@query("toxicity_by_join", f"WITH {TOX} {thrice_sql('round(total / (total + 1), 6)::double AS toxicity', 'tox')}")
def toxicity_by_join(spark, sf):
    t = m.toxicity(thrice(tokens(spark, sf)), X.TOXIC, inline_limit=0, trie_limit=0)
    return shown_id(t).select("doc_id", F.round("toxicity", 6).alias("toxicity"))


@query("policy_verdict_by_trie", f"WITH {POLICY} {thrice_sql('flag, category, reason', 'verdict')}")
def policy_verdict_by_trie(spark, sf):
    """The plan for a policy too long to stand in the plan, looked up in the row."""
    v = m.policy_verdict(thrice(tokens(spark, sf)), X.PHRASES, inline_limit=0)
    return shown_id(v).select("doc_id", "flag", "category", "reason")


@query(
    "toxicity_by_trie",
    f"""WITH {TOX} SELECT doc_id, round(total / (total + 1), 6)::double AS toxicity,
    {', '.join(f'round({c} / ({c} + 1), 6)::double AS {c}' for c in V.TOXICITY_CATEGORIES)} FROM tox""",
)
def toxicity_by_trie(spark, sf):
    t = m.toxicity(tokens(spark, sf), X.TOXIC, inline_limit=0)
    return t.select(
        "doc_id", F.round("toxicity", 6).alias("toxicity"),
        *[F.round(F.col("toxicity_labels")[c], 6).alias(c) for c in V.TOXICITY_CATEGORIES],
    )


@query("prompt_safety_by_join", f"WITH {MODEL} SELECT * FROM prompt")
def prompt_safety_by_join(spark, sf):
    """The plan for a model too large to broadcast."""
    scorer = PromptScorer(model(spark, sf))
    rows = with_row_id(docs(spark, sf).select("doc_id", "text"))
    p = scorer.with_class(rows.join(scorer.word_sums(rows.select("_rid", "text"), "text"), "_rid", "left"))
    return p.select("doc_id", "prompt_class", F.round("prompt_score", 4).alias("prompt_score"), "prompt_log_score")


@query("prompt_safety_repeated_ids", f"WITH {MODEL} {thrice_sql('prompt_class, prompt_log_score', 'prompt')}")
def prompt_safety_repeated_ids(spark, sf):
    p = m.prompt_safety(thrice(docs(spark, sf).select("doc_id", "text")), model(spark, sf))
    return shown_id(p).select("doc_id", "prompt_class", "prompt_log_score")


# --- composite ----------------------------------------------------------------------------------


@query(
    "moderate_text",
    f"""WITH {POLICY}, {SENTIMENT}, {FIRST_PII}
    SELECT doc_id, d.lang, sentiment, coalesce(first.n, 0)::int AS n_pii, flag, verdict.category, reason,
           d.lang <> 'en' AS pending
    FROM documents d JOIN verdict USING (doc_id) JOIN sent USING (doc_id) LEFT JOIN first USING (doc_id)""",
)
def moderate_text(spark, sf):
    r = m.moderate_text(
        docs(spark, sf), lang="lang", policy=X.PHRASES, lexicon=X.SENTIMENTS, id_col="doc_id"
    )
    return r.select(
        "doc_id", "lang", "sentiment", F.size("pii").alias("n_pii"), "flag", "category", "reason", "pending"
    )


@query(
    "analyze_text",
    f"""WITH {SENTIMENT}, {TOX}, {FIRST_PII}, {MODEL}
    SELECT doc_id, sentiment = 'NEGATIVE' AS sentiment_negative,
           CASE WHEN sentiment = 'NEGATIVE' THEN negative ELSE 0.0 END AS negative_score,
           pii_type, round(total / (total + 1), 6)::double AS toxicity, prompt_class, prompt_log_score
    FROM sent JOIN tox USING (doc_id) JOIN prompt USING (doc_id) LEFT JOIN first USING (doc_id)""",
)
def analyze_text(spark, sf):
    r = m.analyze_text(
        docs(spark, sf), model(spark, sf), lang="lang", lexicon=X.SENTIMENTS, toxic_lexicon=X.TOXIC
    )
    return r.select(
        "doc_id", "sentiment_negative", F.round("negative_score", 6).alias("negative_score"), "pii_type",
        F.round("toxicity", 6).alias("toxicity"), "prompt_class", "prompt_log_score",
    )


def thousandths(k: int) -> str:
    """SQL: the exact decimal text of a reply's score."""
    return f"'0.' || lpad(((length(text) * {k}) % 1000)::varchar, 3, '0') || repeat('0', 21)"


TOXIC_REPLY = f"""CASE WHEN doc_id % 10 <> 7 THEN {thousandths(11)} END AS toxicity, {', '.join(
    f"CASE WHEN doc_id % 10 <> 7 THEN {thousandths(i)} END AS {c}" for i, c in enumerate(V.TOXICITY_CATEGORIES, 2))}"""
CLASS_REPLY = f"""CASE WHEN length(text) % 5 = 0 THEN 'UNSAFE_PROMPT' ELSE 'SAFE_PROMPT' END AS prompt_class,
    {thousandths(23)} AS prompt_score"""


def toxic_columns():
    return [F.col("toxicity").cast("string").alias("toxicity"),
            *[F.col("toxicity_labels")[c].cast("string").alias(c) for c in V.TOXICITY_CATEGORIES]]


@query("first_class", f"SELECT doc_id, {CLASS_REPLY} FROM documents")
def first_class(spark, sf):
    c = m.first_class(m.parse_detections(B.detector_replies(spark, sf), "class_reply", "classes"))
    return c.select("doc_id", "prompt_class", F.col("prompt_score").cast("string").alias("prompt_score"))


@query("toxic_result", f"SELECT doc_id, {TOXIC_REPLY} FROM documents")
def toxic_result(spark, sf):
    t = m.toxic_result(m.parse_detections(B.detector_replies(spark, sf), "toxic_reply", "toxic_text"))
    return t.select("doc_id", *toxic_columns())


@query("dominant_language", "SELECT doc_id, lang FROM documents")
def dominant_language(spark, sf):
    d = m.dominant_language(m.parse_detections(B.detector_replies(spark, sf), "language_reply", "languages"))
    return d.select("doc_id", "lang")


@query(
    "analyze_replies",
    f"""SELECT doc_id, lang, ['NEGATIVE', 'POSITIVE', 'NEUTRAL', 'MIXED'][doc_id % 4 + 1] AS sentiment, doc_id % 4 = 0 AS sentiment_negative,
      CASE WHEN doc_id % 4 = 0 THEN {thousandths(17)} ELSE '0.' || repeat('0', 24) END AS negative_score,
      CASE WHEN doc_id % 3 <> 0 THEN CASE WHEN length(text) % 2 = 0 THEN 'EMAIL' ELSE 'PHONE' END END AS pii_type,
      CASE WHEN doc_id % 3 <> 0 THEN {thousandths(7)} END AS pii_score, {TOXIC_REPLY}, {CLASS_REPLY},
      CASE WHEN doc_id % 10 = 7 THEN 'toxic_text' ELSE '' END AS missing FROM documents""",
)
def analyze_replies(spark, sf):
    """The record out of supplied replies of all five kinds, scores as exact decimals."""
    r = m.analyze_replies(B.detector_replies(spark, sf))

    return r.select(
        "doc_id", "lang", "sentiment", "sentiment_negative", F.col("negative_score").cast("string").alias("negative_score"),
        "pii_type", F.col("pii_score").cast("string").alias("pii_score"), *toxic_columns(),
        "prompt_class", F.col("prompt_score").cast("string").alias("prompt_score"), F.array_join("missing", ",").alias("missing"),
    )


@query(
    "text_objects",
    "SELECT 'doc/' || doc_id || '.txt' AS file_uri, length(text)::int AS n, sha256(text) AS text_hash FROM documents",
)
def text_objects(spark, sf):
    """Documents written as one text file each, read back by the reader."""
    folder = scratch_folder(spark, "texts")
    # A file costs the same however small it is, so the files are dealt by number and not by bytes.
    folders = m.write_text_objects(spread_files(load(spark, sf, DOCS), "doc_id"), folder, "doc_id", "text")
    # A file ends with the line break that its writer adds.
    text = F.regexp_replace("text", r"\n\z", "")
    uri = F.concat(F.lit("doc/"), F.regexp_extract("file_uri", "doc_id=(-?[0-9]+)", 1), F.lit(".txt"))
    return m.read_by_folders(spark, folders, lambda paths: m.read_text_objects(spark, paths, compressed=False).select(
        uri.alias("file_uri"), F.length(text).alias("n"), F.sha2(text, 256).alias("text_hash"),
    ))
