"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import rows_key
from conftest import SF_SMALL
from folio.sources.tables import TABLES

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(SQL) >= 50


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source_id", "n_chunks", "n_chars"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(cols) > 0
        return
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == sorted(cols)
    order = [rel.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert rows_key(got) == rows_key(want)
