"""Mergeable KPI parts, and result documents with any arguments."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quaylake.operators import kpi_parts, kpis
from quaylake.sources import results_io

ROWS = "vehicle_id string, revenue double, weight double, day string"


def loads(seed, n=3):
    rng = random.Random(seed)
    nan = float("nan")
    out = []
    for load in range(n):
        rows = [
            (rng.choice([None, "", "V-é", *[f"V-{i}" for i in range(40 * (load + 1))]]), rng.choice([None, nan, float(rng.randint(0, 99))]),
             rng.choice([None, 0.5, float(rng.randint(1, 9))]), f"2026-01-{rng.randint(1, 9):02d}")
            for _ in range(200)
        ]
        out.append(rows)
    return out


def build(spark, tmp_dir, parts):
    known = None
    for rows in parts:
        df = spark.createDataFrame(rows, ROWS)
        kpi_parts.number_values(df, "vehicle_id", known).write.mode("append").parquet(f"{tmp_dir}/words")
        known = spark.read.parquet(f"{tmp_dir}/words")
        kpi_parts.kpi_parts(df, F.col("day"), known).write.mode("append").parquet(f"{tmp_dir}/parts")
    return known, spark.read.parquet(f"{tmp_dir}/parts")


def test_parts_of_several_loads_merge_to_the_whole(spark, tmp_dir):
    parts = loads(1)
    known, stored = build(spark, tmp_dir, parts)
    whole = spark.createDataFrame([r for p in parts for r in p], ROWS)
    assert kpi_parts.merge_parts(stored).collect() == kpis.kpi_summary(whole).collect()
    numbers = sorted(r["number"] for r in known.collect())
    assert numbers == list(range(1, len(numbers) + 1)) and known.select("value").distinct().count() == len(numbers)
    by_day = {r["day"]: tuple(r)[1:] for r in kpi_parts.merge_parts(stored, [("day", F.col("part"))]).collect()}
    for day in {r[3] for p in parts for r in p}:
        assert by_day[day] == tuple(kpis.kpi_summary(whole.where(F.col("day") == day)).first())


def test_many_values_need_several_bitmaps(spark, tmp_dir):
    rows = spark.range(100_000).selectExpr("concat('V', id) AS vehicle_id", "1D AS revenue", "2D AS weight", "cast(id % 3 AS string) AS day")
    numbers = kpi_parts.number_values(rows, "vehicle_id")
    parts = kpi_parts.kpi_parts(rows.unionByName(rows.where("id % 2 = 0") if "id" in rows.columns else rows), F.col("day"), numbers)
    assert parts.select("bucket").distinct().count() == 4
    got = kpi_parts.merge_parts(parts).first()
    assert (got["unique_vehicles"], got["total_shipments"]) == (100_000, 200_000)


def test_empty_parts_and_values_without_a_number(spark):
    none = spark.createDataFrame([], ROWS)
    numbers = kpi_parts.number_values(none, "vehicle_id")
    assert kpi_parts.merge_parts(kpi_parts.kpi_parts(none, F.col("day"), numbers)).collect() == kpis.kpi_summary(none).collect()
    some = spark.createDataFrame([("V-1", 1.0, 1.0, "d")], ROWS)
    with pytest.raises(Exception, match="no number for V-1"):
        kpi_parts.kpi_parts(some, F.col("day"), numbers).collect()


def test_dictionary_is_numbered_in_one_pass_with_bounded_windows(spark):
    plan = kpi_parts.number_values(spark.createDataFrame([], ROWS), "vehicle_id")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nested_arguments_of_any_rule(spark, tmp_dir):
    results = [
        {"success": True, "expectation_config": {"type": "t0", "kwargs": {"column": "a", "mostly": 0.95, "value_set": ["x", "y"]}}},
        {"success": False, "expectation_config": {"type": "t1", "kwargs": {}}},
        {"success": None, "expectation_config": {"type": "t2"}},
        {"success": True, "expectation_config": {"type": "t3", "kwargs": {"range": {"lo": 1, "hi": None}, "strict": True, "n": None, "é": "ü"}}},
    ]
    with open(f"{tmp_dir}/doc.json", "w", encoding="utf-8") as f:
        f.write(json.dumps({"success": False, "results": results}) + "\n")
    rows = results_io.read_arguments(spark, f"{tmp_dir}/doc.json").collect()
    got = {(r["rule_index"], r["expectation"], r["argument"]): (r["kind"], r["value"]) for r in rows}
    assert len(got) == len(rows) == 9
    assert got[0, "t0", "column"] == ("string", "a") and got[0, "t0", "mostly"][1] == "0.95"
    assert got[0, "t0", "value_set"][1] == '["x","y"]' and got[0, "t0", "value_set"][0].startswith("array")
    assert got[1, "t1", None] == got[2, "t2", None] == (None, None)
    assert got[3, "t3", "range"][1] == '{"hi":null,"lo":1}' and got[3, "t3", "strict"] == ("boolean", "true")
    assert got[3, "t3", "n"] == ("void", None) and got[3, "t3", "é"] == ("string", "ü")


def test_empty_document(spark, tmp_dir):
    with open(f"{tmp_dir}/doc.json", "w", encoding="utf-8") as f:
        f.write('{"success": true, "results": []}\n')
    assert results_io.read_arguments(spark, f"{tmp_dir}/doc.json").count() == 0
