import random
from importlib import import_module

from helpers_llm import documents, prose, words

from modspark.llm import near_dedup as n
from modspark.llm.components import components
from modspark.llm.registry import ORACLES
from modspark.operators import joins


def shingles(text, width=4):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return sorted((rows[i][0], len(sets[i]), rows[find(i)][0], find(i) == i) for i in range(len(rows)))


def edited(seed, text, edits):
    r = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.random()}"
    return " ".join(w)


def test_equals_brute_force_on_copies_chains_and_hot_groups(spark):
    base, rows = prose(1, 200), []
    for i in range(80):
        rows.append((i, edited(i, base, i % 4)))
    link = base  # a chain in which only neighbours are near
    for i in range(80, 120):
        link = edited(i, link, 3)
        rows.append((i, link))
    rows += [(200 + i, prose(50 + i, 60)) for i in range(20)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "One two"), (304, "one TWO"), (305, "one"), (306, "É x"), (307, "é x")]
    got = n.near_duplicates(documents(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_missing_and_repeated_ids(spark):
    rows = [(None, prose(1, 30)), (5, prose(1, 30)), (5, prose(2, 30)), (5, prose(2, 30)), (6, prose(2, 30)), (None, None)]
    got = n.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 3
    assert {(r.doc_id, r.component_id) for r in got} == {(None, None), (5, None), (5, 5), (6, 5)}
    assert n.near_duplicates(documents(spark, rows).limit(0)).count() == 0


def test_sketch_share_is_near_similarity():
    import numpy as np

    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 900).astype(np.uint64))
    b = np.sort(np.concatenate([a[:800], r.integers(0, 2**63, 100).astype(np.uint64)]))
    both = n.sketches([a, b, a[:1], a[:5], a[:0]], 160)
    assert (both[:4] != n._EMPTY).all() and (both[4] == n._EMPTY).all()
    assert abs((both[0] == both[1]).mean() - 0.8) < 0.12


def test_components_of_a_long_chain(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(rows, "x long, y long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and got[1000] == got[1001] != got[0]


def test_sql_form_agrees(spark, sf):
    import check
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = n.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    assert check.canonical(got).equals(check.canonical(db.sql(ORACLES["op7_minhash_dedup"]).df()))


def test_crowded_bands_hold_the_same_entries(spark, monkeypatch):
    """The join of crowded bands as a lookup gives what one join by band would."""
    r = random.Random(3)
    entries = [(r.randrange(30) if i % 3 else 7, i, i % 11) for i in range(900)]
    table = spark.createDataFrame(entries, "band long, _row long, n long")
    by_band = {}
    for band, row, size in entries:
        by_band.setdefault(band, []).append((row, size))
    want = sorted((b, row, size, *min(own)) for b, own in by_band.items() if len(own) > 1 for row, size in own)
    for least in (1, 40, 256, 10**6):
        monkeypatch.setattr(n, "CROWDED_BAND", least)
        got = n._buckets(table).select("band", "_row", "n", "x", "m").collect()
        assert sorted(map(tuple, got)) == want


def test_tables_that_fail_the_size_check_are_never_broadcast(spark, monkeypatch):
    base = prose(11, 120)
    rows = [(i, edited(i, base, i % 3)) for i in range(30)] + [(50 + i, prose(50 + i, 40)) for i in range(20)]
    rows += [(100 + i, prose(50 + i, 40)) for i in range(10)]
    plans, keep = [], n.settle

    def noted(df, *parts):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, *parts)

    for place in (n, import_module("modspark.llm.components")):
        monkeypatch.setattr(place, "settle", noted)
    monkeypatch.setattr(import_module("modspark.llm.components"), "BROADCAST_LIMIT", 0, raising=False)
    for place in (n, joins):
        monkeypatch.setattr(place, "is_small", lambda *_: False)
    got = n.near_duplicates(documents(spark, rows))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)
    assert len(plans) > 10 and sum("SortMergeJoin" in p for p in plans) > 5
    assert not [p for p in plans if "Broadcast" in p]
