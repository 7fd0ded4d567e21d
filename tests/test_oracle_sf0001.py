"""Every named query against its DuckDB SQL twin on sf0.001, plus the entry
contract."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from quaylake.plans.catalog import all_queries as queries
from quaylake.plans.oracle import oracle_queries
from quaylake.sources.tables import TABLES

from .conftest import SF0001


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_queries())
    assert set(queries()) <= set(oracle_sql())


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[key])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dtypes
    res = duck.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)
    # no query pairs rows without an equi key
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_contract(spark):
    df = entry(spark)
    assert df.count() == 8
    assert df.columns[:3] == ["rule_index", "rule_column", "expectation"]
