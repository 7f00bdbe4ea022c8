"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    from check_oracle import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module", autouse=True)
def one_guide():
    """The guide is crawled and loaded once for the queries that look at the same run."""
    import functools

    from gleaner.plans import guide_queries

    real = guide_queries._catalogue
    guide_queries._catalogue = functools.lru_cache(maxsize=4)(real)
    yield
    guide_queries._catalogue = real


def _names():
    from __spark_entry__ import oracle_sql

    return sorted(oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    from check_oracle import canon

    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_every_query_registered_has_oracle_or_is_rows_only():
    from __spark_entry__ import oracle_sql, queries

    rows_only = {name for name in set(queries()) - set(oracle_sql()) if name.startswith("q_")}  # not the optional subpackage's
    assert rows_only == set()
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["page_id", "ord", "href", "target", "host", "first_page_id"]
    assert df.count() > 0
