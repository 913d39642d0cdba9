"""Every registered query against its SQL twin, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as repo
from brookmart.plans import stream_queries  # noqa: F401
from brookmart.plans.oracle import ORACLE
from brookmart.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return list(frame.columns), sorted(map(repr, frame.itertuples(index=False, name=None)))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(repo.queries()) and set(ORACLE) <= set(repo.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, db, name):
    got = rows_of(repo.queries()[name](spark, SF).toPandas())
    assert got == rows_of(db.sql(repo.oracle_sql()[name]).df())


def test_entry(spark):
    rows = repo.entry(spark).collect()
    assert [list(r.asDict()) for r in rows] == [["trademark_id", "trademark_name", "amount"]] * 5
