"""Every catalogue query with an oracle, against DuckDB on sf0.001 (the driver checks sf0.01)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from hearth.plans.catalogue import QUERIES
from hearth.plans.oracle import ORACLE
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FITTED = {"gbt_predictions", "cv_results", "feature_importance", "model_metrics", "gbt_deal_labels", "prediction_contributions", "model_nodes"}


def norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def canon(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    got = canon(E.queries()[name](spark, SF_SMALL).toPandas())
    want = canon(con.sql(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_query_has_oracle_or_is_documented():
    no_oracle = set(QUERIES) - set(ORACLE)
    assert no_oracle <= FITTED | {"profile_report"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["neighborhood", "avg_rent_eur"] and df.count() > 0
