"""Every query with SQL equals DuckDB's result on the smallest tables; every query runs with a stable schema."""

import datetime
import decimal

import duckdb
import pytest

from tessera import plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else v + 0.0
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_equals_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    want = duck.sql(plans.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE)))
def test_runs(spark, name):
    df = plans.QUERIES[name](spark, DATA)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_scans_are_pruned(spark):
    plan = plans.QUERIES["symbol_scan"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_suppkey), IsNotNull(l_shipdate), EqualTo(l_suppkey,7)" in plan
    assert "l_comment" not in plan and "l_tax" not in plan


def test_covers_inventory():
    import re

    ids = set(re.findall(r"[A-Z]{3}-\d\d", " ".join(plans.COVERS.values())))
    assert len(ids) >= 190
