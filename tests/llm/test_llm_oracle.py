"""The registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tessera.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


def rounded(v):
    return float(f"{v:.12g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted((tuple(rounded(r[c]) for c in cols) for r in df.collect()), key=key)
    at = [want.columns.index(c) for c in cols]
    assert got == sorted((tuple(rounded(r[i]) for i in at) for r in want.fetchall()), key=key)
