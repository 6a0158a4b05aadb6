"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans import registry
from ledgerline.sources.tables import TABLES, table_path

from .conftest import SF_SMALL

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_key_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_names, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["review_hour", "avg_rating", "review_count"]
    assert df.count() > 0
