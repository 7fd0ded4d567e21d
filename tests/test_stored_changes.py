"""Changes to stored tables: only changed partitions are rewritten, bucketed targets stay
in place, joins prune both layouts."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from quaylake.operators import dml, evolve, partitions
from quaylake.plans import catalog, lab
from quaylake.schemas import SHIPMENT_SCHEMA
from quaylake.sources import catalog as ddl
from quaylake.sources import fixtures

from .conftest import SF0001

COLUMNS = SHIPMENT_SCHEMA.names


def make(spark, rows):
    """Rows from (shipment_id, origin, weight, status)."""
    full = [(i, o, "X", "V-1", w, "Low", 1.0, s, "2026-01-01 00:00:00") for i, o, w, s in rows]
    return spark.createDataFrame(full, SHIPMENT_SCHEMA)


def table_of(spark, tmp_dir, rows):
    table = evolve.Layout(f"{tmp_dir}/table", ("origin",))
    evolve.write_layout(make(spark, rows), table)
    return table


def content(spark, table):
    rows = evolve.read_layouts(spark, [table], SHIPMENT_SCHEMA).select("shipment_id", "origin", "weight", "status").collect()
    return sorted(map(tuple, rows), key=repr)


def files(table):
    return {
        os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, names in os.walk(table.path)
        for f in names
        if f.endswith(".parquet")
    }


def touched(before, after):
    """Partition folders with a file that is new, gone or changed."""
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    return {os.path.basename(os.path.dirname(f)) for f in changed}


ROWS = [("a", "Delhi", 1.0, "s"), ("b", "Delhi", 2.0, "t"), ("c", "Pune", 3.0, "s"), ("d", "", 4.0, "s"), ("e", None, 5.0, "t"), ("f", "Goa", 6.0, "t")]


def test_update_rewrites_partitions_with_hits_only(spark, tmp_dir):
    table = table_of(spark, tmp_dir, ROWS)
    before = files(table)
    done = partitions.update_partitions(spark, table, SHIPMENT_SCHEMA, "weight IN (2, 4)", {"status": F.lit("u")})
    assert {r["origin"] for r in done} == {"Delhi", ""}
    assert touched(before, files(table)) == {"origin=Delhi", "origin=%01"}
    want = [(i, o, w, "u" if w in (2, 4) else s) for i, o, w, s in ROWS]
    assert content(spark, table) == sorted(want, key=repr)


def test_update_of_the_partition_field_moves_rows(spark, tmp_dir):
    table = table_of(spark, tmp_dir, ROWS)
    before = files(table)
    partitions.update_partitions(spark, table, SHIPMENT_SCHEMA, "origin = 'Pune' OR origin IS NULL", {"origin": F.lit("Goa")})
    assert touched(before, files(table)) == {"origin=Pune", "origin=Goa", "origin=__HIVE_DEFAULT_PARTITION__"}
    assert not os.path.exists(f"{table.path}/origin=Pune")
    assert content(spark, table) == sorted([(i, "Goa" if o in ("Pune", None) else o, w, s) for i, o, w, s in ROWS], key=repr)


def test_delete_removes_emptied_partitions(spark, tmp_dir):
    table = table_of(spark, tmp_dir, ROWS)
    before = files(table)
    partitions.delete_partitions(spark, table, SHIPMENT_SCHEMA, "origin = 'Goa' OR origin = '' OR weight = 1 OR origin IS NULL")
    assert touched(before, files(table)) == {"origin=Delhi", "origin=Goa", "origin=%01", "origin=__HIVE_DEFAULT_PARTITION__"}
    assert content(spark, table) == [("b", "Delhi", 2.0, "t"), ("c", "Pune", 3.0, "s")]
    assert partitions.delete_partitions(spark, table, SHIPMENT_SCHEMA, "weight > 99") == []


def test_merge_rewrites_matched_and_inserted_partitions(spark, tmp_dir):
    table = table_of(spark, tmp_dir, ROWS)
    before = files(table)
    source = make(spark, [("c", "Pune", 3.5, "m"), ("z", "Agra", 9.0, "n"), (None, "Delhi", 8.0, "n")])
    done = partitions.merge_partitions(spark, table, SHIPMENT_SCHEMA, source, "shipment_id", {"status": "status", "weight": "weight"})
    assert {r["origin"] for r in done} == {"Pune", "Agra", "Delhi"}
    assert touched(before, files(table)) == {"origin=Pune", "origin=Agra", "origin=Delhi"}
    want = [(i, o, 3.5 if i == "c" else w, "m" if i == "c" else s) for i, o, w, s in ROWS] + [("z", "Agra", 9.0, "n"), (None, "Delhi", 8.0, "n")]
    assert content(spark, table) == sorted(want, key=repr)


def test_merge_that_moves_rows_and_merge_of_one_clause(spark, tmp_dir):
    table = table_of(spark, tmp_dir, ROWS)
    source = make(spark, [("f", "Delhi", 0.0, "x"), ("y", "Goa", 7.0, "x")])
    before = files(table)
    partitions.merge_partitions(spark, table, SHIPMENT_SCHEMA, source, "shipment_id", {"ORIGIN": "origin"}, insert=False)
    assert touched(before, files(table)) == {"origin=Goa", "origin=Delhi"}
    assert ("f", "Delhi", 6.0, "t") in content(spark, table)
    before = files(table)
    partitions.merge_partitions(spark, table, SHIPMENT_SCHEMA, source, "shipment_id")
    assert touched(before, files(table)) == {"origin=Goa"}
    assert len(content(spark, table)) == 7
    with pytest.raises(Exception, match="more than one source row"):
        twice = make(spark, [("a", "Delhi", 0.0, "1"), ("a", "Delhi", 0.0, "2")])
        partitions.merge_partitions(spark, table, SHIPMENT_SCHEMA, twice, "shipment_id", {"status": "status"})
    assert len(content(spark, table)) == 7


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def bucketed(spark, tmp_dir):
    name = f"quaylake_test.t{abs(hash(tmp_dir))}"
    ddl.ensure_database(spark, "quaylake_test", f"{tmp_dir}/db")
    ddl.write_bucketed(fixtures.shipments(spark, SF0001), name, ["shipment_id"], 5, f"{tmp_dir}/bucketed")
    yield spark.table(name)
    ddl.drop_table(spark, name)


def operators_above(plan, mark):
    """For each line with ``mark``, the operators from it up to the first join."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[ :+\-|*]*(\(\d+\) )?", x).group()) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if mark in line:
            at, above = depth[i], []
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    above.append(lines[j])
                    if "Join" in lines[j]:
                        break
            found.append(above)
    return found


def test_bucketed_target_is_not_moved(spark, bucketed):
    source = fixtures.duplicate_key_source(spark, SF0001)
    update = {"status": "status", "timestamp": "timestamp"}
    merged = dml.merge_into(bucketed, source, "shipment_id", update, buckets=5)
    plan = plan_of(merged)
    scans = operators_above(plan, "Bucketed: true")
    assert len(scans) == 2 and all("SortMergeJoin" in above[-1] for above in scans)
    assert not any("Exchange" in x for above in scans for x in above)
    assert plan.count("Exchange") == 2 and "Broadcast" not in plan  # the source, dealt once for each join
    plain = dml.merge_into(fixtures.shipments(spark, SF0001), source, "shipment_id", update)
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, plain.collect()))


def test_join_prunes_both_layouts(spark):
    df = catalog.partition_evolved_pruned(spark, SF0001)
    df.collect()
    plan = plan_of(df)
    assert plan.count("dynamicpruning") >= 1
    pushed = re.search(r"PushedFilters: \[[^\]]*In\(origin, \[([^\]]*)\]\)", plan)
    assert pushed and len(pushed.group(1).split(",")) == 5
    old = lab.clustered_layouts(spark, SF0001)[0]
    # the old root is clustered: files hold ranges of origins, so most row groups are skipped
    held = spark.read.parquet(old.path).groupBy(F.col("_metadata.file_path")).agg(F.min("origin").alias("lo"), F.max("origin").alias("hi"))
    spans = sorted((r["lo"], r["hi"]) for r in held.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_large_dimension_is_joined_without_pushed_values(spark, monkeypatch):
    monkeypatch.setattr(evolve, "PUSHED_VALUES", 2)
    df = catalog.partition_evolved_pruned(spark, SF0001)
    assert "In(origin" not in plan_of(df)
    nations = spark.read.parquet(f"{SF0001}/nation.parquet").join(spark.read.parquet(f"{SF0001}/region.parquet").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    ships = fixtures.shipments(spark, SF0001).join(nations, F.col("origin") == F.col("n_name"), "left_semi")
    assert ships.count() > 100
    assert sorted(map(repr, df.select(*COLUMNS).collect())) == sorted(map(repr, ships.select(*COLUMNS).collect()))
