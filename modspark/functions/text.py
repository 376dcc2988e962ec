"""Column functions over text: tokens, hit counts, personal data, verdict parsing.

Functions named ``*_sql`` return SQL text: an expression over a long list of words is built by one
call instead of one call per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PII_TYPE = "array<struct<type:string,begin:int,end:int,score:double>>"
_PLACED_TYPE = "array<struct<begin:int,end:int,type:string,score:double>>"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and their marks, in order; a missing text has none."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(words: Iterable[str]) -> str:
    """Fixed strings as the right side of SQL ``IN`` (a hash set once there are more than ten)."""
    return f"({', '.join(map(sql_string, sorted(set(words))))})"


def hits_sql(words: str, wanted: Iterable[str]) -> str:
    """SQL: how many elements of array column ``words`` belong to a fixed set."""
    wanted = set(wanted)
    return f"size(filter(`{words}`, w -> w IN {sql_list(wanted)}))" if wanted else "0"


def keep_sql(words: str, wanted: Iterable[str]) -> str:
    """SQL: the elements of array column ``words`` that belong to a fixed set."""
    wanted = set(wanted)
    if not wanted:
        return "cast(array() AS array<string>)"
    return f"filter(`{words}`, w -> w IN {sql_list(wanted)})"


def matching_chars(text: Column, pattern: str) -> Column:
    """Number of characters that match a one-character pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def phrases_sql(words: str, phrases: Iterable[str]) -> str:
    """SQL: the listed phrases wherever their words stand next to each other in ``words``.

    Only places whose word starts some phrase are looked at, so a long text costs one hash lookup
    per word and string building at the few places that can match.
    """
    phrases = set(phrases)
    if not phrases:
        return "cast(array() AS array<string>)"
    first = sql_list(p.split(" ")[0] for p in phrases)
    sizes = ", ".join(str(n) for n in sorted({len(p.split(" ")) for p in phrases}))
    return f"""
      flatten(transform(
        filter(transform(`{words}`, (w, i) -> IF(w IN {first}, i + 1, NULL)), p -> p IS NOT NULL),
        p -> filter(
          transform(
            filter(array({sizes}), n -> p + n - 1 <= size(`{words}`)),
            n -> array_join(slice(`{words}`, p, n), ' ')),
          g -> g IN {sql_list(phrases)})))"""


def n_grams(words: Column, sizes: Sequence[int]) -> Column:
    """All word n-grams of the given sizes."""
    lengths = F.array(*[F.lit(int(n)) for n in sorted(set(sizes))])
    return F.flatten(
        F.transform(
            words,
            lambda _, i: F.transform(
                F.filter(lengths, lambda n: i + n <= F.size(words)),
                lambda n: F.array_join(F.slice(words, i + 1, n), " "),
            ),
        )
    )


# Places are summed up inside blocks of so many matches; a list grown match by match is copied each time.
_BLOCK = 256


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _pattern_sql(text: str, kind: str, pattern: str, score: float) -> str:
    # The text is cut at the matches; walking over (piece before, match) pairs keeps the offset.  Each
    # block of matches is walked from where it begins, so time is in proportion to the matches.
    p = sql_string(pattern)
    whole = f"regexp_extract_all({text}, {p}, 0)"
    pairs = f"""zip_with(
          slice(split({text}, {p}, -1), 1, size({whole})),
          zip_with({whole}, regexp_extract_all({text}, {p}, 1),
                   (w, c) -> named_struct('whole', length(w), 'cue', length(c))),
          (piece, m) -> named_struct('before', length(piece), 'whole', m.whole, 'cue', m.cue))"""
    cut = f"""transform(sequence(0, (size(pairs) - 1) div {_BLOCK}),
          k -> slice(pairs, k * {_BLOCK} + 1, {_BLOCK}))"""
    starts = """aggregate(blocks, named_struct('upto', 0, 'at', cast(array() AS array<int>)),
          (acc, b) -> named_struct(
            'upto', acc.upto + aggregate(b, 0, (n, m) -> n + m.before + m.whole), 'at', concat(acc.at, array(acc.upto))),
          acc -> acc.at)"""
    walked = f"""aggregate(
          b, named_struct('upto', start, 'found', cast(array() AS {_PLACED_TYPE})),
          (acc, m) -> named_struct(
            'upto', acc.upto + m.before + m.whole,
            'found', concat(acc.found, array(named_struct(
              'begin', acc.upto + m.before + m.cue, 'end', acc.upto + m.before + m.whole,
              'type', {sql_string(kind)}, 'score', {float(score)!r}D)))),
          acc -> acc.found)"""
    placed = _let("blocks", cut, f"flatten(zip_with(blocks, {starts}, (b, start) -> {walked}))")
    return f"""
      CASE WHEN {text} RLIKE {p} THEN {_let('pairs', pairs, placed)}
      ELSE cast(array() AS {_PLACED_TYPE}) END"""


def pii_sql(text: str, patterns: Sequence[tuple]) -> str:
    """SQL: personal data in ``text`` as (type, begin, end, score), ordered by place.

    Offsets count characters from 0, the end is exclusive.  Group 1 of a pattern is a leading cue
    outside the entity; the entity ends the match.  An optional fourth item of a pattern is a
    literal, or a character class in brackets, that every match contains: texts without it are
    passed over by one cheap test for all patterns that share it.
    """
    if not patterns:
        return f"cast(array() AS {PII_TYPE})"
    by_need: dict[str | None, list[str]] = {}
    for kind, pattern, score, *needs in patterns:
        need = needs[0] if needs else None
        by_need.setdefault(need, []).append(_pattern_sql(text, kind, pattern, score))
    groups = []
    for need, found in by_need.items():
        group = f"concat({', '.join(found)})"
        if need:
            test = f"{text} RLIKE {sql_string(need)}" if need.startswith("[") else (
                f"contains({text}, {sql_string(need)})")
            group = f"CASE WHEN {test} THEN {group} ELSE cast(array() AS {_PLACED_TYPE}) END"
        groups.append(group)
    every = ", ".join(groups)
    return f"""
      transform(array_sort(concat({every})), e -> named_struct(
        'type', e.`type`, 'begin', e.`begin`, 'end', e.`end`, 'score', e.`score`))"""


def json_verdict(reply: Column) -> Column:
    """Struct (flag, category, reason, parse_ok) out of a free reply holding a JSON object.

    The flag has three values: NULL means undecided and must go to a person, never pass.
    """
    block = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    parsed = F.from_json(
        block, "flag STRING, category STRING, reason STRING", {"allowUnquotedControlChars": "true"}
    )
    said = F.lower(F.trim(parsed["flag"]))
    flag = (
        F.when(said.isin("yes", "true", "unsafe"), F.lit(True))
        .when(said.isin("no", "false", "safe"), F.lit(False))
    )
    return F.struct(
        flag.alias("flag"),
        parsed["category"].alias("category"),
        parsed["reason"].alias("reason"),
        F.coalesce(said.isNotNull(), F.lit(False)).alias("parse_ok"),
    )


def line_verdict(reply: Column, unquote: bool = False) -> Column:
    """Map of the ``key:value`` lines after the first line; the last of equal keys wins.

    A line counts only when it has exactly one colon.  A reply without line break is used whole.
    """
    body = F.when(
        F.instr(reply, "\n") > 0, F.substring(reply, F.instr(reply, "\n") + 1, F.length(reply))
    ).otherwise(reply)
    pairs = F.filter(
        F.transform(F.split(body, r"\R"), lambda line: F.split(line, ":", -1)),
        lambda parts: F.size(parts) == 2,
    )

    def clean(part: Column) -> Column:
        return F.regexp_replace(part, r"^\s+|\s+$", "")

    def value(part: Column) -> Column:
        stripped = clean(part)
        return F.regexp_replace(stripped, '^"(.*)"$', "$1") if unquote else stripped

    entries = F.transform(
        pairs, lambda p: F.struct(clean(p[0]).alias("key"), value(p[1]).alias("value"))
    )
    # Keys are compared against the later entries, so the session's duplicate-key policy is moot.
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(last)


def exact(score: Column) -> Column:
    """Float score as an exact decimal with the same shortest decimal text."""
    return score.cast("decimal(38,24)")
