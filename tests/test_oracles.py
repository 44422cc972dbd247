"""Every registered query against the SQL that DuckDB runs on the same tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from factloom.plans import registry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v if isinstance(v, int) else str(v)


def key(row):
    return tuple((x is not None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    res = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=key)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_oracle_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert E.entry(spark).count() > 0
