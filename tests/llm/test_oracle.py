"""Queries with SQL twins on sf0.001."""

from __future__ import annotations

import duckdb
import pytest

from quaylake.llm.catalog import llm_oracle, llm_queries
from quaylake.sources.tables import TABLES

from ..conftest import SF0001


@pytest.mark.parametrize("key", sorted(llm_oracle()))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    want = con.execute(llm_oracle()[key])
    names = [d[0] for d in want.description]
    df = llm_queries()[key](spark, SF0001)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_native_queries_plan_no_python(spark):
    for key in ("op1_benchmark_decontamination", "op6_line_dedup", "op9_chat_formatting", "op10_sharding", "op12_license_scans"):
        plan = llm_queries()[key](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")), key
