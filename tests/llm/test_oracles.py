"""Each operator with SQL against DuckDB at the smallest size."""

from __future__ import annotations

import duckdb
import pytest
from awkward import AWKWARD  # noqa: F401 - keeps the helper importable on its own

from quarry.llm.oracle import ORACLE
from quarry.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))
    want = sorted(map(str, con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()))
    assert got == want
