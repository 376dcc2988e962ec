import itertools
import random
import re

from helpers_llm import documents, prose

from modspark.llm import decontaminate as d

TOKEN = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def tokens(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in TOKEN.findall(text or "")]


def overlapping(doc, item):
    a, b = tokens(doc), tokens(item)
    if not b:
        return False
    if len(b) < 16:
        return any(a[i:i + len(b)] == b for i in range(len(a) - len(b) + 1))
    return any(
        sum(x == y for x, y in zip(a[i:i + 16], b[j:j + 16], strict=True)) >= 13
        for i in range(len(a) - 15) for j in range(len(b) - 15)
    )


def test_masks_meet_every_placement_of_three_substitutions():
    places = [d._read_places(m) for m in d.MASKS]
    for wrong in itertools.combinations(range(16), 3):
        assert any(
            not any(s + k in wrong for k in read) for read in places for s in range(16 - read[-1])
        ), wrong


def items_and_documents():
    r = random.Random(3)
    items = [(i, prose(i, r.randint(16, 40))) for i in range(12)] + [(50, "just four short words"), (51, None), (52, ""), (53, "Straße, GRÜN")]
    rows = []
    for i in range(60):
        w = items[i % 12][1].split()
        cut = w[r.randint(0, 3):]
        for k in range(r.randint(0, 7)):
            cut[r.randrange(len(cut))] = f"z{k}"
        rows.append((i, prose(500 + i, 20) + "\n" + ", ".join(cut).upper() + "! " + prose(600 + i, 10)))
    rows += [(100, None), (101, ""), (102, "so: just FOUR short words."), (103, "just four long short words"), (104, "x straße grün"),
             (None, items[0][1]), (102, items[1][1]), (105, prose(1, 5000) + " " + items[2][1])]
    return items, rows


def test_equals_brute_force(spark):
    items, rows = items_and_documents()
    bench = spark.createDataFrame([(*x, 1) for x in items + items[:2]], "item_id long, text string, _row int")
    got = d.decontaminate(documents(spark, rows).repartition(3), bench).collect()
    want = sorted((str(i), ",".join(str(k) for k, t in items if overlapping(text, t))) for i, text in rows)
    assert sorted((str(r.doc_id), r.items) for r in got) == want
    assert all(r.contaminated == (r.n_items > 0) for r in got)


def test_blocks_give_the_same(spark):
    items, rows = items_and_documents()
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = documents(spark, [r for r in rows if r[0] not in (None, 102)]).withColumnRenamed("doc_id", "k")
    from modspark.llm.common import ordered_rows

    keyed = ordered_rows(table, "k")
    one = sorted(map(tuple, d.contaminated_items(keyed, bench).collect()))
    many = sorted(map(tuple, d.contaminated_items(keyed, bench, block_bytes=300).collect()))
    assert one == many and one
    assert d.decontaminate(documents(spark, rows), bench.limit(0)).filter("contaminated").count() == 0
    assert d.decontaminate(documents(spark, rows).limit(0), bench).count() == 0


def test_refined_keys_meet_every_placement_of_three_substitutions():
    """Where a seed is whole in a window, some pair of groups is too, wherever the substitutions are."""
    for kind, mask in enumerate(d.MASKS):
        read = d._read_places(mask)
        by_place = {}
        for _, place, extra in d._refinements(kind):
            by_place.setdefault(place, []).append(set(extra))
        for place, extras in by_place.items():
            seed = {place + k for k in read}
            assert all(not e & seed and len(e) == 4 for e in extras) and len(extras) == 10
            for wrong in itertools.combinations(sorted(set(range(16)) - seed), 3):
                assert any(not e & set(wrong) for e in extras), (mask, place, wrong)


def test_crowded_seeds_lose_no_hit(spark):
    """Items that share a preamble: plain, refined and brute force give the same."""
    r = random.Random(8)
    preamble = prose(77, 10)
    items = [(i, preamble + " " + prose(1000 + i, r.randint(4, 20))) for i in range(40)] + [(99, preamble), (None, prose(5, 18))]
    rows = []
    for i in range(60):
        w = items[i % 40][1].split()
        for k in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"z{k}"
        rows.append((i, prose(3000 + i, 8) + " " + " ".join(w if i % 3 else preamble.split() + prose(4000 + i, 30).split())))
    rows.append((200, " ".join([preamble] * 50) + " " + items[3][1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows).repartition(3)
    from modspark.llm.common import ordered_rows

    want = sorted((i, k if k is not None else -1) for i, text in rows for k, t in items if overlapping(text, t))
    keyed = ordered_rows(docs)
    for hot in (1, 10, 10**6):
        got = d.contaminated_items(keyed, bench, hot=hot).collect()
        assert sorted((x._row, -1 if x.item_id is None else x.item_id) for x in got) == want, hot


def test_preamble_without_hits_is_no_product(spark):
    """2,000 items and 2,000 documents that share ten words: few places are compared."""
    preamble = prose(77, 10)
    items = spark.createDataFrame([(i, preamble + " " + prose(10_000 + i, 20)) for i in range(2000)], "i long, t string")
    seeds, crowded = d.item_keys(items)
    assert crowded.count() > 0
    per_key = seeds.groupBy("_key").count().agg({"count": "max"}).head()[0]
    assert per_key <= d.HOT
    docs = documents(spark, [(i, prose(50_000 + i, 5) + " " + preamble + " " + prose(20_000 + i, 30)) for i in range(2000)])
    from modspark.llm.common import ordered_rows

    got = d.contaminated_items(ordered_rows(docs), items.withColumnsRenamed({"i": "item_id", "t": "text"}))
    assert got.count() == 0
