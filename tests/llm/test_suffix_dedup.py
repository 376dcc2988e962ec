import hashlib
import random
from collections import Counter

from helpers_llm import documents, prose

from modspark.llm import suffix_dedup as s


def expected(rows, length=100):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, out = set(), []
    for i, text in order:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus():
    r = random.Random(5)
    base, shared = prose(1, 400), prose(2, 40)
    rows = [(1, base), (2, base), (3, base[:50] + "Ü" + base[51:900] + "!" + base[905:]), (4, None), (5, ""), (6, "x" * 5000),
            (7, "é" * 300), (8, base[200:299]), (9, base[200:300]), (10, "ab" * 700 + base[:120])]
    for i in range(20, 60):
        cut = r.randint(0, 60)
        rows.append((i, prose(i, r.randint(0, 60)) + " " + shared[cut:] + prose(100 + i, 30) + shared[: 100 + cut]))
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    got = s.remove_repeats(documents(spark, rows).repartition(5)).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_missing_and_repeated_ids(spark):
    rows = [(None, prose(1, 60)), (3, prose(1, 60)), (3, prose(1, 60)), (3, prose(2, 60)), (None, None), (7, prose(2, 60) + "é" * 80)]
    got = s.remove_repeats(documents(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_long_texts_in_pieces(spark, monkeypatch):
    import modspark.llm.kernels as k

    rows = [(1, prose(3, 3000)), (2, prose(4, 500) + prose(3, 3000)[5000:9000] + prose(5, 500)), (3, "q" * 30_000)]
    table = documents(spark, rows)
    batch = table.select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    whole, parts = [], []
    for limit, out in ((k.PIECE_BYTES, whole), (1000, parts)):
        for p in k.pieces(batch.column(1), 99, limit):
            h = k.Slices(p.data).windows(100)
            for j, (a, b) in enumerate(zip(p.starts, p.ends)):
                out += [(p.first + j, p.base + i, int(h[a + i])) for i in range(b - a - 99)]
    assert sorted(whole) == sorted(parts) and len(set(whole)) == len(whole)


def test_kept_texts_hold_whole_characters_and_empty_table(spark):
    from modspark.llm.common import keyed

    rows = [(1, "é" * 60 + "abc"), (2, "x" + "é" * 60 + "z"), (3, None)]
    got = {r._id: r._kept for r in s.kept_texts(keyed(documents(spark, rows))).collect()}
    assert got[2] == "xz" or set(got[2]) <= {"x", "é", "z"}
    assert got[3] == "" and s.remove_repeats(documents(spark, rows).limit(0)).count() == 0


def test_a_common_passage_shorter_than_the_window_meets_no_single_task(spark):
    """One passage of 95 bytes in every document, between other text: its digits are crowded."""
    from pyspark.sql import functions as F

    from modspark.llm.common import ordered_rows

    passage = prose(9, 40)[:95]
    rows = [(i, f"{prose(1000 + i, 12)} {passage} {prose(9000 + i, 12)}") for i in range(3000)]
    docs = ordered_rows(documents(spark, rows)).select("_row", "_text")
    crowded = s.crowded_digits(docs)
    assert 0 < len(crowded) <= 56
    runs = docs.mapInArrow(s._collect(lambda b: s._runs(b.column(0), b.column(1), 100), crowded), s.RUNS)
    by_digit = runs.groupBy("a").count().agg(F.max("count")).head()[0]
    assert by_digit >= 1000
    spread = s._dealt(runs).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert spread.max() < 1.3 * spread.median()


def test_crowded_digits_change_no_result(spark, monkeypatch):
    passage = prose(9, 40)[:95]
    rows = [(i, f"{prose(1000 + i, 6)} {passage}{'ab'[i % 2] * (i % 9)} {prose(9000 + i % 7, 9)}") for i in range(90)]
    rows += corpus()[:8]
    want = expected(rows)
    for least in (2, 10**9):
        monkeypatch.setattr(s, "CROWDED_RUNS", least)
        got = s.remove_repeats(documents(spark, rows).repartition(6)).collect()
        assert Counter(tuple(r) for r in got) == want
