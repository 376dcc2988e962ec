import re

from pyspark.sql import functions as F

from modspark.llm import url_filter as u
from modspark.llm.queries import RULES

URLS = [
    "http://a.net/x", "https://NET/", "http://net", "http://example.net/en/1", "http://x.example.net/en", "http://myexample.net/en/",
    "http://example.com/de/?q", "http://w.example.com/dex", "http://a.org/fr/x", "http://org/fr/", "http://a.org:80/fr/", "no scheme", "",
    None, "x://", "http://a.com/p/#f", "http://www.bad.com/x/", "https://bad.com/x?y=1#z", "http://bad.com/X", "http://Ünï.net/ä",
    "a://b://c/d", "http://bad.com/x", "http://h.org?x/fr/", "http://user@bad.com/x",
]


def expected(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    key = re.sub(r"^www\.", "", host) + re.sub("/+$", "", path)
    known = bool(key) and key in listed
    return host, path, rule and rule.name, rule.verdict if rule else "block" if known else "allow", known


def test_equals_brute_force(spark):
    rows = [(i, x, 1, "v") for i, x in enumerate(URLS)] + [(None, "http://bad.com/x", 1, "v"), (1, "http://bad.com/x", 1, "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, listed int, verdict string")
    listed = spark.createDataFrame([("bad.com/x",), ("bad.com/x",), (None,), ("",), ("other.com/y",)], "canonical string")
    got = u.filter_urls(pages, listed, RULES).collect()
    want = sorted(str((i, *expected(x, {"bad.com/x", "other.com/y"}))) for i, x, *_ in rows)
    assert sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict, r.listed)) for r in got) == want


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("h.com/"), F.col("id")).alias("k"))
    blocks, n = u.blocked_bloom_filter(keys.filter("substring(k, 7) < 5000"), "k")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("m")) == F.col("m"), F.lit(False))
    tested = keys.select("k", u.bloom_block(F.col("k"), n).alias("_block"), u.bloom_mask(F.col("k")).alias("m")).join(blocks, "_block", "left")
    counts = tested.groupBy((F.substring("k", 7, 9).cast("int") < 5000).alias("known"), hit.alias("hit")).count().collect()
    n = {(r.known, r.hit): r["count"] for r in counts}
    assert (True, False) not in n and n.get((False, True), 0) < 0.03 * 15_000


def test_empty_list_and_pages(spark):
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "canonical string")
    assert u.filter_urls(pages, none, []).filter("verdict <> 'allow'").count() == 0
    assert u.filter_urls(pages.limit(0), none, RULES).count() == 0
