"""Every query with SQL gives the same rows on Spark and DuckDB, at the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from furrow.plans import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{DIR}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def plain(df):
    df = df[sorted(df.columns)]

    def value(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or type(x).__name__ in ("NAType", "NaTType"):
            return ""
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        if hasattr(x, "__float__") and not isinstance(x, str):
            return f"{float(x) + 0.0:.6f}"
        return str(x)

    return sorted(tuple(value(x) for x in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_its_sql(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, DIR).toPandas(), duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
