from collections import Counter

from helpers_llm import documents, prose, words

from modspark.llm import quality_rules as q


def expected(text):
    text = text or ""
    w = words(text)
    counts = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if counts[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_statistics_equal_brute_force(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b c"), (6, "a a a a"), (7, "x y z x y z q"),
        (8, "one\n\none\ntwo\none"), (9, "é#*$ %&|<> \x0b ü\x1cu"), (10, prose(1, 3000) + " " + prose(1, 200)), (10, "a b"),
        (None, "null id here"), (11, "ab " * 5000),
    ]
    got = q.text_statistics(documents(spark, rows)).select("doc_id", *q.BASE).collect()
    want = Counter((i, *expected(t)) for i, t in rows)
    assert Counter(tuple(r) for r in got) == want


def test_rules_find_thresholds_and_order(spark):
    rows = [(i, 100 + i % 7, 500, (60 if i % 4 == 0 else i % 3), 0, 0, 0, 90, i % 4 == 0) for i in range(400)]
    rows += [(1000 + i, 100, 500, 0, 0, 0, 450 if i % 2 else 5, 90, bool(i % 2)) for i in range(200)]
    names = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_capitals long, n_distinct long, bad boolean"
    labelled = spark.createDataFrame(rows, names)
    rules = q.fit_rules(labelled)
    assert {c.feature for r in rules for c in r.conditions} >= {"symbols_per_word", "capitals_per_char"}
    judged = labelled.select("bad", (q.decision(rules) > 0).alias("rejected")).collect()
    assert all(r.bad == r.rejected for r in judged)


def test_held_out_accuracy(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("doc_id % 5 <> 0")
    verdicts = q.quality_verdicts(docs, train).join(labels.filter("doc_id % 5 = 0"), "doc_id").filter("n_words >= 50").collect()
    good = [r.kept for r in verdicts if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in verdicts if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_no_labels_and_empty_tables(spark):
    docs = documents(spark, [(1, prose(3, 80)), (2, "short")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in q.quality_verdicts(docs, none).collect()} == {1: True, 2: False}
    assert q.quality_verdicts(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(None, 0), (1, None), (1, 0), (1, 0)], "doc_id long, quality int")
    assert q.quality_verdicts(docs, odd).count() == 2
