"""Every catalogue query against its SQL on the small tables."""

from __future__ import annotations

import datetime
import decimal

import duckdb
import pytest

from tripforge.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(columns, found):
    return sorted((tuple(plain(v) for v in r) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, sf, sql, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    want = sql.sql(catalog.SQL[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    got = rows(columns, df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == rows(columns, [[r[i] for i in place] for r in want.fetchall()])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
