"""Every registered query against its DuckDB oracle SQL on the smallest data folder."""

import duckdb
import pytest

import __spark_entry__ as E
from contentspark.sources.tables import TABLES
from scripts.oracle_check import digest

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, sf_small, key):
    df = QUERIES[key](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, sf_small, key):
    QUERIES[key](spark, sf_small).write.format("noop").mode("overwrite").save()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "rank"]
    assert df.count() >= 0
