import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"
MORE = ["size", "source_size", "target", "taken"]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with missing values, repeated rows and columns named like those of the stages."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    some = d.limit(2)
    odd = spark.createDataFrame(
        [(9001, None, "en", "src0", 0), (9002, "", None, None, 0), (None, "a text without id", "en", "src1", 17),
         (9003, "word " * 30_000, "en", "src2", 150_000)], d.schema)
    return d.unionByName(some).unionByName(odd).withColumns(
        {"_row": F.lit("r"), "_id": F.lit(1.5), "_text": F.lit("t"), "_size": F.lit("s"), "_hash": F.lit(0), "_source": F.lit("z"),
         "size": F.lit("own"), "Target": F.lit("own"), "kept": F.lit(True), "toxic": F.lit("x"), "_all": F.lit("all")})


def plain(rows, columns):
    return sorted(str(tuple(r[c] for c in columns)) for r in rows)


def test_stages_keep_the_columns_and_clean_odd_rows(spark, docs):
    given = docs.collect()
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        rows = out.collect()
        assert 0 < len(rows) < len(given) or name == "benchmark decontamination", name
        # Whatever a stage takes away, it invents nothing; missing and empty texts stay.
        if name != "suffix-array dedup":
            assert set(plain(rows, out.columns)) <= set(plain(given, out.columns)), name
        ids = [r.doc_id for r in rows]
        assert 9001 in ids and 9002 in ids, name


def test_copies_go_and_repeats_are_cut(spark, docs):
    one = docs.filter("doc_id = 9003")
    twice = one.unionByName(one.withColumn("doc_id", F.lit(9004).cast("long")))
    assert [r.doc_id for r in p.drop_near_duplicates(spark, twice, SF).collect()] == [9003]
    left = p.cut_repeats(spark, one, SF).head()
    assert len(left.text) < 200 and left.n_chars == len(left.text)


def test_mix_replaces_columns_of_its_names_and_agrees_with_itself(spark, docs):
    out = p.mix(spark, docs, SF)
    assert out.columns == [c for c in docs.columns if c not in ("size", "Target")] + MORE
    rows = out.collect()
    assert plain(rows, out.columns) == plain(p.mix(spark, docs.repartition(3), SF).collect(), out.columns)
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()} - {9001, 9002}
    for r in rows:
        assert r["_size"] == "s" and r.size == len(r.text.split()) and r.taken in (r.size, 2 * r.size)


def test_empty_table_and_whole_run(spark, docs):
    for _, stage in p.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
    out = p.run(spark, SF)
    base = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns == [*base.columns, *MORE]
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(ids) == len(set(ids)) < base.count()


def test_dropped_rows_beyond_the_limit_are_not_broadcast(spark, docs, monkeypatch):
    def near(limit):
        monkeypatch.setattr(p, "DROPPED_LIMIT", limit, raising=False)
        return p.drop_near_duplicates(spark, docs, SF)

    usual, beyond = near(1_000_000), near(0)
    assert "SortMergeJoin" in (plan := beyond._jdf.queryExecution().executedPlan().toString()) and "Broadcast" not in plan
    assert plain(beyond.collect(), docs.columns) == plain(usual.collect(), docs.columns)
