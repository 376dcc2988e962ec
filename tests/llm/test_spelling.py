import random
import re
import zlib
from collections import Counter, defaultdict

from helpers_llm import documents
from pyspark.sql import functions as F

from modspark.llm import spelling as s

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def expected(rows):
    n = counted(rows)
    around = defaultdict(list)
    for a in n:
        for b in n:
            if near(a, b):
                around[a].append(b)
    form = {}
    for w in n:
        best = min(around[w], key=lambda b: (-n[b], b), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(around[w]), form.get(w), n[form[w]] if w in form else None, root))
    return sorted(out)


def texts():
    r = random.Random(5)
    stems = ["".join(r.choice("abé") for _ in range(r.randint(6, 9))) for _ in range(25)] + ["ÀÀÀaaaa", "aaaaaaa", "aaaaaaaa", "Übungen"]
    rows = []
    for i in range(150):
        w = []
        for _ in range(25):
            x = list(stems[int(r.paretovariate(0.7)) % len(stems)])
            if r.random() < 0.15:
                x[r.randrange(len(x))] = r.choice("abéz")
            if r.random() < 0.1:
                x.insert(r.randrange(len(x) + 1), r.choice("abé"))
            w.append("".join(x))
        rows.append((i, r.choice([" ", "-", "_9", "…"]).join(w).title()))
    chain = ["chaining"] * 1000 + ["chaning"] * 100 + ["chanixg"] * 10
    return rows + [(900, None), (901, ""), (None, "missing missing missings"), (902, " ".join(chain)), (902, " ".join(chain))]


def rows_of(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def test_equals_brute_force(spark):
    rows = texts()
    want = expected(rows)
    assert sum(w[3] is not None for w in want) > 3
    assert rows_of(s.spelling_variants(documents(spark, rows).repartition(3))) == want
    assert s.spelling_variants(documents(spark, rows).limit(0)).count() == 0
    assert s.spelling_variants(documents(spark, [(1, "no long ones")])).count() == 0


def test_large_blocks_are_cut_into_tiles(spark):
    r = random.Random(3)
    texts = {"".join(r.choice("ab") for _ in range(r.randint(9, 11))) for _ in range(700)}
    words = spark.createDataFrame([(w, 2) for w in texts], "word string, n long")
    want = sorted((a, b) for a in texts for b in texts if near(a, b))
    whole = s.near_words(words, zone=12)
    cut = s.near_words(words, zone=12, tile=20)
    assert sorted((x.word, x.near) for x in whole.collect()) == want
    assert sorted((x.word, x.near) for x in cut.collect()) == want
    cells = s.tiles(s.blocks(words, zone=12), 20).groupBy("cell").agg(F.count("*").alias("n")).agg(F.max("n")).head()[0]
    assert cells < 120


def test_words_are_whole_in_long_texts(spark):
    text = ("ab " * 400_000 + "boundary" * 40_000) + " " + "boundary " * 3
    got = {r.word: r.n for r in s.variant_words(documents(spark, [(1, text)]), least_n=1, drop_every=1 << 40).collect()}
    assert got == {"boundary" * 40_000: 1, "boundary": 3}
