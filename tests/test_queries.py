"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import os

import pytest

import __spark_entry__

SF = os.environ.get("TIMELOOM_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    asked = duck.execute(__spark_entry__.oracle_sql()[name])
    order = [c[0] for c in asked.description]
    assert sorted(order) == columns
    want = sorted(tuple(str(r[order.index(c)]) for c in columns) for r in asked.fetchall())
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
