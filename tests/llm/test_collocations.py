import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from helpers_llm import documents
from pyspark.sql import functions as F

from modspark.llm import collocations as c

ENDS = re.compile("[.,;:!?\x0a-\x0d]")
WORD = re.compile("[^\x20\x09]+")


def pieces(text):
    text = "".join(x.lower() if x.isascii() else x for x in text or "")
    return [WORD.findall(p) for p in ENDS.split(text)]


def counted(rows):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang or "und"][tuple(w[i:i + m])] += 1
    return f, n


def expected(rows, least, top):
    f, n = counted(rows)
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        kept = []
        for p, a in found.items():
            inside = any(
                len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= 80 * a for q, b in found.items())
            if not inside:
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts():
    r = random.Random(9)
    vocabulary = ["new", "York", "city", "of", "the", "Été", "a　b", "x y", "(no)", "new"]
    rows = []
    for i in range(160):
        w = [r.choice(vocabulary) + r.choice(["", "", "", "", ",", ".", "\n", "!"]) for _ in range(r.randint(0, 60))]
        if i % 3 == 0:
            w.insert(len(w) // 2, "in the New\tYork city hall")
        rows.append((["en", "de", None, "EN"][i % 4], r.choice([" ", "  ", "\t"]).join(w)))
    return rows + [("en", None), ("de", ""), (None, " . , "), ("fr", "alone")] * 2


def table(spark, rows):
    return documents(spark, list(enumerate(t for _, t in rows))).withColumn("lang", F.lit(None).cast("string")).drop("lang").join(
        spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, lang string"), "doc_id")


def test_equals_brute_force(spark):
    rows = texts()
    docs = table(spark, rows).withColumn("n", F.lit(1)).withColumn("w1", F.lit("x")).repartition(3)
    got = [tuple(r) for r in c.collocations(docs, least=5).collect()]
    want = expected(rows, 5, 2000)
    assert len(want) > 100 and sorted(got) == want
    few = [tuple(r) for r in c.collocations(docs, least=5, top=7).collect()]
    assert sorted(few) == expected(rows, 5, 7)
    assert c.collocations(docs.limit(0)).count() == 0


def test_exact_beyond_64_bits(spark, monkeypatch):
    big = 9 * 10**13
    counts = [("en", [], 4 * big), ("en", ["a"], big), ("en", ["b"], 2 * big), ("en", ["a", "b"], big - 1)]
    made = spark.createDataFrame(counts, "lang string, words array<string>, f long")
    monkeypatch.setattr(c, "phrase_counts", lambda *_: made)
    r = c.collocations(spark.createDataFrame([("en", "")], "lang string, text string")).head()
    assert r.score == 2000000 * (big - 1) // (3 * big) and (r.l, r.r, r.n) == (big, 2 * big, 4 * big)


def test_parts_of_a_long_text_give_the_same(monkeypatch):
    r = random.Random(2)
    words = ["one", "two", "three", "long" * 30]
    for sign in ("", ". "):
        text = " ".join(r.choice(words) + (sign if r.random() < 0.1 else "") for _ in range(2000)) + " " + "x" * 3000 + " end"
        column = pa.array([text, "", "of two"])

        def windows(limit, column=column):
            out = Counter()
            for part in c._parts(column, 3, limit):
                leads = c._Leads(part, np.zeros(3, dtype=np.int64), 4)
                out.update(map(tuple, leads.words.T.tolist()))
            return out

        assert windows(1 << 20) == windows(700) and sum(windows(1 << 20).values()) == 2004


def test_windows_sum_to_all_prefixes(spark):
    rows = texts()
    got = {(r.lang, tuple(r.words)): r.f for r in c.phrase_counts(table(spark, rows), least=1).collect()}
    f, n = counted(rows)
    want = {(lang, p): a for lang, counts in f.items() for p, a in counts.items()} | {(lang, ()): k for lang, k in n.items() if k}
    assert got == want


def test_a_bit_set_of_bounded_size_lets_frequent_pairs_pass(spark, monkeypatch):
    monkeypatch.setattr(c, "SIEVE_BITS", c.BLOCK_BITS * 2)
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    sieve = c.Sieve(spark.createDataFrame([(int(k),) for k in keys], "gram long"))
    assert sieve.bits == c.BLOCK_BITS * 2
    assert c.may_pass(sieve.shared.value, keys.view(np.uint64)).all()
    assert c.may_pass(sieve.shared.value, np.arange(1000, dtype=np.uint64) << np.uint64(3)).mean() < 0.5


def test_counts_that_fail_the_size_check_are_not_broadcast_with_their_repeats(spark, monkeypatch):
    frames, join = [], c.lookup_join
    monkeypatch.setattr(c, "lookup_join", lambda *a: frames.append(join(*a, small=False)) or frames[-1])
    rows = texts()
    out = c.collocations(spark.createDataFrame(rows, "lang string, text string"), least=4, top=30)
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out.collect())
    assert got == expected(rows, 4, 30)
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in frames]
    assert len(plans) == 3 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
