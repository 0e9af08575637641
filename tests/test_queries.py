"""Every query with an SQL twin gives its rows on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from folioforge.plans import content_queries, queries  # noqa: F401  both register queries

SF = "/root/testdata/sf0.001"


def rows(frame: pd.DataFrame):
    def plain(v):
        if pd.isna(v):
            return ""
        return v if isinstance(v, str) else str(round(float(v), 6))

    return sorted(tuple(plain(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, duck, name):
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(queries.ORACLES[name]).df())


def test_the_rest_runs(spark):
    for name in set(queries.QUERIES) - set(queries.ORACLES):
        assert queries.QUERIES[name](spark, SF).count() > 0
