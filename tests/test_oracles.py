"""Every registered query against its DuckDB reference SQL on the sf0.001 tables (the driver's gate, small)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tools.check_oracles import TABLES, rows

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF['0.001']}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF["0.001"])
    got = df.collect()
    if name not in SQL:
        # estimates, models and the pipeline: their rows are checked in tests of their own
        assert got and all(len(r) == len(df.columns) for r in got)
        if name == "uv_approx":
            exact = dict(con.sql(f"SELECT window_end, cnt FROM ({SQL['unique_visitor']})").fetchall())
            assert {r["window_end"] for r in got} == set(exact)
            assert all(abs(r["cnt"] - exact[r["window_end"]]) <= 1 + 0.05 * exact[r["window_end"]] for r in got)
        return
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, got) == rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"] and df.count() > 0
