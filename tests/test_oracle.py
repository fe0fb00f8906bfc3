"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# the training-data queries have tests of their own
SQL = {k: v for k, v in E.oracle_sql().items() if k in catalog.QUERIES}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(SQL[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    si = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    di = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    srows = sorted(tuple(_norm(r[i]) for i in si) for r in sdf.collect())
    drows = sorted(tuple(_norm(r[i]) for i in di) for r in rel.fetchall())
    assert srows == drows


def test_every_query_has_oracle_or_is_listed():
    rows_only = {"kpi_latency_percentiles", "gbt_scores", "top_features", "newton_stages", "newton_scores"}
    assert set(catalog.QUERIES) - set(SQL) == rows_only


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 605
    assert "churn_risk_label" in df.columns
