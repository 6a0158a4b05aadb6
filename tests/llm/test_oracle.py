"""Queries of the subpackage against their DuckDB SQL."""

from collections import Counter

import duckdb
import pytest

from ledgerline.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = QUERIES[key](spark, SF_SMALL)
    cur = con.execute(ORACLE_SQL[key])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    norm = lambda row: tuple(round(v, 9) if isinstance(v, float) else v for v in row)
    assert Counter(norm(r) for r in df.select(*names).collect()) == Counter(norm(r) for r in cur.fetchall())
