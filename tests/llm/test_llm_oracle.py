"""The queries of this subpackage against their SQL twins; names, and files that stay away."""

import duckdb
import pytest

import __spark_entry__ as repo
from brookmart.llm.oracle import ORACLE
from brookmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return list(frame.columns), sorted(map(repr, frame.itertuples(index=False, name=None)))


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(repo.queries()) and set(ORACLE) <= set(repo.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(db.sql(ORACLE[name]).df())
