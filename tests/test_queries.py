"""Every registered query against its checking SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import check
from workload.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return connection


def test_every_query_has_its_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, db, name):
    got = check.canonical(QUERIES[name](spark, sf).toPandas())
    want = check.canonical(db.sql(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "lang", "sentiment", "n_pii", "flag", "category", "reason", "pending"]
    assert df.count() == 200


def test_objects_keep_every_turn_of_a_long_conversation(spark, sf, tmp_path):
    for t in check.TABLES:
        if t != "conversations":
            (tmp_path / f"{t}.parquet").symlink_to(f"{sf}/{t}.parquet")
    short = spark.read.parquet(f"{sf}/conversations.parquet").filter("conv_id <> 3")
    long = spark.range(2500).selectExpr("3L AS conv_id", "id AS turn", "'user' AS role", "concat('said ', id) AS text")
    short.unionByName(long).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    connection = duckdb.connect()
    for t in check.TABLES:
        files = f"{tmp_path}/{t}.parquet" + ("/*.parquet" if t == "conversations" else "")
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{files}'")
    got = QUERIES["moderate_objects"](spark, str(tmp_path)).toPandas()
    assert check.canonical(got).equals(check.canonical(connection.sql(ORACLES["moderate_objects"]).df()))
