"""The registered queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from hearth.llm.oracle import ORACLE
from hearth.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    cols = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(plain(x) for x in r) for r in want.select(*cols).fetchall()), key=repr)
