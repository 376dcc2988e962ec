from helpers_llm import documents, prose, words

from modspark.llm import mixing as m


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free = {}, set(names)
    left = share * sum(sizes.values())
    while free:
        whole = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / whole > most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / whole for s in free}
            break
        target |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target


def corpus():
    rows = [(i, prose(i, 5 + i * 7 % 90), ["a", "b", "ab", "é", "Z", "😀", None, "hot"][min(7, i % 20)]) for i in range(600)]
    return rows + [(1000, None, "a"), (1001, "", None), (None, "x y", "a"), (None, "x y", "a"), (1002, " \n", "blank only")]


def test_targets_sizes_and_nearness(spark):
    rows = corpus()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = expected_targets(sizes)
    docs = documents(spark, rows)
    got = m.mix_sources(docs.repartition(6)).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(got) == len(rows) - 2
    taken, largest = {}, {}
    text = {r[0]: r[1] for r in rows}
    for r in got:
        assert r.size == len(words(text[r.doc_id])) and r.taken in (0, r.size, 2 * r.size)
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(largest[s], 4)
    again = m.mix_sources(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, m.mix_sources(docs).collect()))


def test_word_counts(spark):
    texts = ["", " ", "a", " a ", "a b", "\x0ba\x0c\tb\r\nc", "a\u00a0b", "a\x1fb  c", None]
    docs = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r.n for r in docs.select("doc_id", m.word_count(docs.text).alias("n")).collect()}
    assert got == {i: len(words(t)) for i, t in enumerate(texts)}


def test_empty_table_and_many_sources(spark):
    docs = documents(spark, corpus())
    assert m.mix_sources(docs.limit(0)).count() == 0
    many = documents(spark, [(i, "w " * (1 + i % 5), f"s{i:04d}") for i in range(300)])
    got = m.mix_sources(many).collect()
    want = expected_targets({f"s{i:04d}": 1 + i % 5 for i in range(300)})
    assert all(abs(r.target - want[f"s{r.doc_id:04d}"]) < 1e-6 for r in got)
