"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import settle
from modspark.operators.joins import lookup_join

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BITS = 64


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(_part(url, r"^([^/?#]*)"), CAPITALS, SMALL)


def url_path(url: Column) -> Column:
    return _part(url, r"^[^/?#]*([^?#]*)")


def _part(url: Column, pattern: str) -> Column:
    """A part of a URL behind its scheme; empty without ``://`` or without a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.regexp_extract(F.coalesce(rest, F.lit("")), pattern, 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without closing slashes; scheme, query and fragment are left out."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def matching_rule(host: Column, path: Column, rules: Sequence[UrlRule], value: str = "name") -> Column:
    """The longest rule that fits, as its name or verdict; null if none does.

    A rule fits its host and the hosts below it if the path starts with the rule's.
    """
    chain = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        chain = (F if chain is None else chain).when(fits, F.lit(getattr(rule, value)))
    return F.lit(None).cast("string") if chain is None else chain


def bloom_block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("long"))


def bloom_mask(key: Column, n_bits: int = 6) -> Column:
    """The bits that a key sets in its block: ``n_bits`` of 64, from one second hash."""
    h = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for k in range(n_bits):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def blocked_bloom_filter(keys: DataFrame, key: str, bits_per_key: int = 16) -> tuple[DataFrame, int]:
    """``(_block, _bits)`` and the number of blocks.  A key lies in one 64-bit block."""
    n_blocks = max(1, keys.count() * bits_per_key // BLOCK_BITS)
    return settle(
        keys.groupBy(bloom_block(F.col(key), n_blocks).alias("_block"))
        .agg(F.bit_or(bloom_mask(F.col(key))).alias("_bits"))
    ), n_blocks


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url: str = "url",
    listed_col: str = "canonical",
) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict``, ``listed``.

    ``listed`` tells whether the canonical URL is in the list.  The Bloom filter passes every URL
    that is, and a few others, to an exact hash join with the list, which removes those.  The verdict
    is the rule's; without a rule, ``block`` for listed URLs and ``allow`` for others.

    A missing URL or one without ``://`` has empty host and path and is never listed.  Rows and list
    may repeat; rows are judged each on their own.  Only keys of the list reach the filter, whose
    blocks are broadcast if they pass a size check and joined by salted keys if not.
    """
    list_keys = settle(
        listed.select(F.col(listed_col).alias("_key")).filter(F.length("_key") > 0).distinct()
    )
    blocks, n_blocks = blocked_bloom_filter(list_keys, "_key")
    host, path = url_host(F.col(url)), url_path(F.col(url))
    parts = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    keyed = parts.withColumn("_key", canonical_url(F.col("host"), F.col("path"))).withColumns({
        "_block": bloom_block(F.col("_key"), n_blocks), "_mask": bloom_mask(F.col("_key")),
    })
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    tested = settle(
        lookup_join(keyed, blocks, "_block", ["_id"], "left")
        .select("_id", "host", "path", "_key", (hit & (F.col("_key") != "")).alias("_possible"))
    )
    sure = tested.filter(~F.col("_possible")).withColumn("listed", F.lit(False))
    exact = lookup_join(
        tested.filter("_possible"), list_keys.withColumn("listed", F.lit(True)), "_key", ["_id"], "left"
    ).withColumn("listed", F.coalesce("listed", F.lit(False)))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = matching_rule(F.col("host"), F.col("path"), rules, "verdict")
    return sure.unionByName(exact).select(
        F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed",
    )
