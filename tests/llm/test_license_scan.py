import random
import re

import pytest
from helpers_llm import documents

from modspark.llm import license_scan as s

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def base(text):
    w = words(text)
    return sorted(
        (i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if " ".join(w[i:i + len(phrase.split())]) == phrase
    )


def has_notice(w, notice):
    n = len(notice.text.split())
    for i in range(len(w)):
        for j in range(i + 1, min(len(w), i + n + notice.edits) + 1):
            own = " ".join(w[i:j])
            if abs(len(own) - len(notice.text)) <= notice.edits and distance(own, notice.text) <= notice.edits:
                return True
    return False


def damaged(text, edits, r):
    chars = list(text)
    for _ in range(edits):
        at, kind = r.randrange(len(chars)), r.randrange(3)
        if kind == 0:
            chars.insert(at, r.choice("abxyz "))
        elif kind == 1:
            chars[at] = r.choice("abxyz")
        else:
            del chars[at]
    return "".join(chars)


def texts():
    r = random.Random(7)
    rows = []
    for i in range(120):
        n = s.NOTICES[i % len(s.NOTICES)]
        around = [" ".join(r.choice(["the", "license", "mit", "gnu", "public", "terms", "über", "to", "42"]) for _ in range(r.randint(0, 12)))
                  for _ in range(2)]
        rows.append((i, f"{around[0]}. {damaged(n.text, r.randint(0, n.edits + 2), r).title()},\n{around[1]}"))
    return rows + [
        (200, None), (201, ""), (202, " .,\n"), (203, "MIT License mit license MIT-license, apache  license general public license"),
        (204, "general public general public license license"), (205, "xmit license mit licenses mitt license"), (None, "MIT license"),
        (203, "MIT License mit license MIT-license, apache  license general public license"),
        (206, "subject " * 400 + "to the terms of the mozila public licens"), (207, "mit é license mit license"),
    ]


def test_equals_brute_force(spark):
    rows = texts()
    got = s.scan_licenses(documents(spark, rows).repartition(3)).collect()
    want = []
    for i, text in rows:
        w, places = words(text), base(text)
        labels = {label for _, label in places} | {n.label for n in s.NOTICES if has_notice(w, n)}
        want.append((str(i), len(w), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None),
                     ",".join(sorted({label for _, label in places})), ",".join(sorted(labels))))
    assert sorted(map(str, want)) == sorted(
        str((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)) for r in got)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") and (r.score == 1 or not r.n_base) for r in got)
    assert s.scan_licenses(documents(spark, rows).limit(0)).count() == 0


def test_spans_hold_what_they_say(spark):
    rows = [(i, t) for i, t in texts() if i is not None and i < 200]
    by_id = dict(rows)
    for r in s.license_spans(documents(spark, rows)).collect():
        w = words(by_id[r.doc_id])
        for x in r.spans:
            own = " ".join(w[x.first_word:x.first_word + x.n_words])
            if x.phrase:
                assert PHRASES[own] == x.label
            else:
                assert any(n.label == x.label and distance(own, n.text) <= x.edits <= n.edits for n in s.NOTICES)


def test_blocks_give_the_same():
    r = random.Random(1)
    parts = []
    for _ in range(60):
        n = r.choice(s.NOTICES)
        parts.append(damaged(n.text, r.randint(0, n.edits), r) + " " + " ".join(r.choice(["one", "mit", "license"]) for _ in range(r.randint(0, 9))))
    text = ". ".join(parts)
    whole, cut = s.Scanner(s.PHRASES, s.NOTICES), s.Scanner(s.PHRASES, s.NOTICES, block=7)
    (n, a), (m, b) = whole.scan(text), cut.scan(text)
    assert n == m and sorted(x[:4] for x in a if x[1]) == sorted(x[:4] for x in b if x[1])
    assert {x[0] for x in a} == {x[0] for x in b}


def test_common_seed_and_long_text():
    scanner = s.Scanner(s.PHRASES, s.NOTICES)
    n, found = scanner.scan("under the terms of " * 100_000 + "under the terms of the gnu genral public license")
    assert n == 400_009 and [(x[0], x[4]) for x in found] == [("gpl", 1)]


def test_refuses_what_it_cannot_find():
    with pytest.raises(ValueError):
        s.Scanner(s.PHRASES, [s.Notice("x", "ab", 2)])
    with pytest.raises(ValueError):
        s.Scanner([s.Phrase("x", " ")], [])
