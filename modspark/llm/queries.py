"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.llm import (
    chat_format,
    collocations,
    decontaminate,
    html_extract,
    license_scan,
    mixing,
    near_dedup,
    quality_rules,
    spelling,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from modspark.llm.common import table
from modspark.llm.registry import query


@query("op1_quality_rules")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# The last conversation holds control strings and a backslash in front of them.
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), steps AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), 'start') AS earlier,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS later FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ') + length(role) + 1 + length('</turn>') + 1
    + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e')))::bigint AS formatted_chars,
  bool_and((earlier, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'),
                               ('user', 'assistant'), ('assistant', 'user')))
    AND bool_or(later IS NULL AND role = 'assistant') AS valid
FROM steps GROUP BY conv_id
"""


@query("op2_chat_format", CHAT_SQL)
def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = r"\### Assistant: </turn> ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(trap).alias("text"),
    )
    return chat_format.chat_digests(chat_format.format_chats(given.unionByName(added)))


@query("op6_source_mixing")
def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


RULES = [
    url_filter.UrlRule("block", "net", "/"), url_filter.UrlRule("allow", "example.net", "/en/"),
    url_filter.UrlRule("block", "example.com", "/de/"), url_filter.UrlRule("allow", "org", "/fr/"),
]

URL_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), keyed AS (
  SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') AS key FROM parts
), listed AS (
  SELECT DISTINCT key FROM keyed WHERE regexp_matches(host, '(^|[.-])(spam|pills)([.-]|$)') AND key <> ''
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
    key IN (SELECT key FROM listed) AS listed
  FROM keyed
)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM judged
""".replace("\\\\", "\\")


@query("op10_url_filter", URL_SQL)
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the canonical URLs of all pages on hosts named after spam."""
    pages = table(spark, sf_dir, "pages")
    parts = pages.select(url_filter.url_host(F.col("url")).alias("h"), url_filter.url_path(F.col("url")).alias("p"))
    listed = parts.filter(F.col("h").rlike(r"(^|[.-])(spam|pills)([.-]|$)")).select(
        url_filter.canonical_url(F.col("h"), F.col("p")).alias("canonical")
    )
    return url_filter.filter_urls(pages, listed, RULES)


@query("op3_suffix_dedup")
def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


# All pairs that share a shingle, then components by spreading the smallest id along links.
NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT d.doc_id, coalesce(max(n), 0)::bigint AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""


@query("op7_minhash_dedup", NEAR_SQL)
def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_toxicity")
def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on about 20,000 labelled documents, scored on all."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity_scores(docs, toxicity.label_model(docs, table(spark, sf_dir, "labels")))


@query("op5_token_counts")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_html_extract")
def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


# CRC-32 byte by byte over a table made from its polynomial; near words as words that agree after one
# letter is left out; roots by following forms.
SPELLING_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(0, 8)::UBIGINT[], lambda c, k: CASE WHEN c % 2 = 1
    THEN xor(c // 2, 3988292384) ELSE c // 2 END, i::UBIGINT) ORDER BY i) AS t FROM range(256) AS r(i)
), lowered AS (
  SELECT coalesce(doc_id::varchar, '') AS id,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents WHERE text IS NOT NULL
), runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]+')) AS run FROM lowered
  ) WHERE length(run) >= 7 GROUP BY id, run
), hexed AS (SELECT *, hex(encode(id || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::int, 2))::UBIGINT),
    lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::int]), 4294967295::UBIGINT), 4294967295) AS crc
  FROM hexed, crc_table
), written AS (
  SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, (crc % length(run))::int) || substr(run, (crc % length(run) + 2)::int)
    ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::bigint AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), without AS (
  SELECT word, n, k, substr(word, 1, (k - 1)::int) || substr(word, (k + 1)::int) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM without a JOIN without b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top, min(struct_pack(m := -n, w := other)).w AS first FROM near GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::bigint AS n_near, CASE WHEN top >= 10 * w.n THEN first END AS form,
    CASE WHEN top >= 10 * w.n THEN top END::double AS form_n
  FROM words w LEFT JOIN best USING (word)
), ways(word, root) AS (
  SELECT word, word FROM judged
  UNION ALL SELECT ways.word, form FROM ways JOIN judged ON judged.word = ways.root WHERE form IS NOT NULL
), ends AS (SELECT ways.word, root FROM ways JOIN judged j ON j.word = root WHERE j.form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM judged JOIN ends USING (word)
"""


@query("op11_spelling_variants", SPELLING_SQL)
def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM split, range(1, 5) AS sizes(m))
), counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase),
totals AS (SELECT lang, sum(f)::bigint AS n FROM counts WHERE m = 1 GROUP BY lang),
found AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m >= 2 AND f >= 30),
known AS MATERIALIZED (SELECT lang, phrase, f FROM counts WHERE f >= 30),
sides AS MATERIALIZED (
  SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM found)
), cuts AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, (2000000::hugeint * c.f // (l.f + r.f))::bigint AS score
  FROM sides c JOIN known l ON l.lang = c.lang AND l.phrase = c.first JOIN known r ON r.lang = c.lang AND r.phrase = c.rest
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, f, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, m - size + 2)) AS i FROM found, range(2, 4) AS sizes(size) WHERE size < m)
), held AS (
  SELECT DISTINCT p.lang, p.phrase FROM found p JOIN inner_phrases q ON p.lang = q.lang AND p.phrase = q.phrase
  WHERE 100 * q.f >= 80 * p.f
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest ANTI JOIN held USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", PHRASE_SQL)
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
