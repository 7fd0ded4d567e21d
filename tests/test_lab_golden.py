"""Golden states of the table-operations lab: insert, update, merge, time
travel, add column, partition evolution."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quaylake.operators import dml, evolve, versions
from quaylake.schemas import DELIVERY_RATING, SHIPMENT_SCHEMA
from quaylake.session import shared_dir

from .version_log import Log


def _by_id(df):
    return {r["shipment_id"]: r.asDict() for r in df.collect()}


def test_insert_update_merge(spark, seed, incoming):
    empty = spark.createDataFrame([], SHIPMENT_SCHEMA)
    t = dml.insert_append(empty, seed)
    assert {k: v["status"] for k, v in _by_id(t).items()} == {
        "SH-1001": "In Transit",
        "SH-1002": "Vehicle Assigned",
        "SH-1003": "Delivered",
    }
    t = dml.update_where(t, "shipment_id = 'SH-1001'", {"status": "'Out for Delivery'"})
    assert _by_id(t)["SH-1001"]["status"] == "Out for Delivery"
    t = dml.merge_into(t, incoming, "shipment_id", {"status": "status", "timestamp": "timestamp"})
    rows = _by_id(t)
    assert len(rows) == 4
    assert rows["SH-1002"]["status"] == "In Transit"
    assert rows["SH-1002"]["timestamp"] == "2026-07-15 10:00:00"
    assert rows["SH-1004"]["status"] == "Shipment Created"
    assert rows["SH-1001"]["status"] == "Out for Delivery"
    assert rows["SH-1003"]["status"] == "Delivered"


def test_versioned_lab(spark, seed, incoming):
    shared_dir(spark)
    table = Log(spark, SHIPMENT_SCHEMA)
    c1 = table.insert(seed)
    c2 = table.update("shipment_id = 'SH-1001'", {"status": "'Out for Delivery'"})
    c3 = table.merge(incoming, "shipment_id", {"status": "status", "timestamp": "timestamp"})
    assert (c1, c2, c3) == (1, 2, 3)

    current = _by_id(table.current())
    assert len(current) == 4
    assert current["SH-1002"]["status"] == "In Transit"
    assert current["SH-1001"]["status"] == "Out for Delivery"

    # as of the first commit: the three seed rows unmodified
    first = versions.first_commit(table.commits())
    assert first == 1
    assert sorted(tuple(r) for r in table.as_of(first).collect()) == sorted(tuple(r) for r in seed.collect())

    hist = versions.history(table.commits()).orderBy("snapshot_id").collect()
    assert [r["snapshot_id"] for r in hist] == [1, 2, 3]
    assert [r["parent_id"] for r in hist] == [None, 1, 2]
    assert all(r["is_current_ancestor"] for r in hist)

    snaps = versions.snapshots(table.commits()).orderBy("snapshot_id").collect()
    assert [r["operation"] for r in snaps] == ["append", "overwrite", "overwrite"]
    assert snaps[0]["summary"]["added-records"] == "3"
    assert snaps[2]["summary"]["added-records"] == "1"
    assert snaps[2]["summary"]["updated-records"] == "1"
    assert snaps[2]["summary"]["total-records"] == "4"

    table.delete("status = 'Delivered'")
    assert "SH-1003" not in _by_id(table.current())
    assert "SH-1003" in _by_id(table.as_of(3))


def test_unknown_commit_is_refused(spark, seed):
    shared_dir(spark)
    table = Log(spark, SHIPMENT_SCHEMA)
    table.insert(seed)
    with pytest.raises(ValueError, match="999"):
        table.as_of(999)
    with pytest.raises(RuntimeError, match="at least 2"):
        versions.first_commit(table.commits())


def test_as_of_latest_equals_current_state(spark, seed, incoming):
    shared_dir(spark)
    table = Log(spark, SHIPMENT_SCHEMA)
    table.insert(seed)
    table.merge(incoming, "shipment_id", {"status": "status"})
    direct = dml.merge_into(seed, incoming, "shipment_id", {"status": "status"})
    assert sorted(table.current().collect()) == sorted(direct.collect())
    assert sorted(table.as_of(2).collect()) == sorted(direct.collect())


def test_add_column_reads_null_then_update(spark, seed, tmp_dir):
    path = f"{tmp_dir}/plain"
    seed.write.parquet(path)
    evolved = evolve.evolved_schema(SHIPMENT_SCHEMA, DELIVERY_RATING)
    t = evolve.read_declared(spark, path, evolved)
    assert [r["delivery_rating"] for r in t.collect()] == [None, None, None]
    t = dml.update_where(t, "status = 'Delivered'", {"delivery_rating": 5})
    ratings = {r["shipment_id"]: r["delivery_rating"] for r in t.select("shipment_id", "status", "delivery_rating").collect()}
    assert ratings == {"SH-1001": None, "SH-1002": None, "SH-1003": 5}
    # new files written with the column and old ones without read together
    t.where("delivery_rating IS NOT NULL").write.mode("append").parquet(path)
    again = evolve.read_declared(spark, path, evolved)
    assert again.count() == 4
    assert again.where("delivery_rating = 5").count() == 1


def test_add_column_on_catalog_table(spark, seed, tmp_dir):
    name = "quaylake_test_ship"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    seed.write.option("path", f"{tmp_dir}/cat").saveAsTable(name)
    evolve.add_columns_sql(spark, name, DELIVERY_RATING)
    assert "delivery_rating" in spark.table(name).columns
    assert spark.table(name).where("delivery_rating IS NULL").count() == 3
    assert spark.catalog.tableExists(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not spark.catalog.tableExists(name)


def test_partition_evolution_keeps_old_rows_and_prunes(spark, seed, incoming, tmp_dir):
    old, new = evolve.Layout(f"{tmp_dir}/v1"), evolve.Layout(f"{tmp_dir}/v2", ("origin",))
    evolve.write_layout(seed, old)
    evolve.write_layout(incoming, new)
    t = evolve.read_layouts(spark, [old, new], SHIPMENT_SCHEMA)
    assert t.count() == 5
    assert t.schema == SHIPMENT_SCHEMA
    hyd = t.where(F.col("origin") == "Hyderabad")
    assert [r["shipment_id"] for r in hyd.collect()] == ["SH-1004"]
    plan = hyd._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [CASE WHEN (origin" in plan


def test_catalog_ddl_helpers(spark, tmp_dir):
    from quaylake.sources import catalog

    catalog.ensure_database(spark, "quaylake_db")
    name = "quaylake_db.shipments"
    catalog.drop_table(spark, name)
    assert not catalog.table_exists(spark, name)
    catalog.ensure_table(spark, name, SHIPMENT_SCHEMA, location=f"{tmp_dir}/t")
    catalog.ensure_table(spark, name, SHIPMENT_SCHEMA, location=f"{tmp_dir}/t")  # idempotent
    assert catalog.table_exists(spark, name)
    assert spark.table(name).schema == SHIPMENT_SCHEMA
    assert not catalog.table_exists(spark, "no_such_db.no_such_table")
    catalog.drop_table(spark, name)
    assert not catalog.table_exists(spark, name)


def test_merge_is_idempotent(spark, seed, incoming):
    upd = {"status": "status", "timestamp": "timestamp"}
    once = dml.merge_into(seed, incoming, "shipment_id", upd)
    twice = dml.merge_into(once, incoming, "shipment_id", upd)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_repeated_rows_keep_their_own_versions(spark, seed, incoming):
    shared_dir(spark)
    table = Log(spark, SHIPMENT_SCHEMA)
    table.insert(seed)
    table.insert(incoming)  # a plain insert: SH-1002 is there twice
    assert table.current().count() == 5
    table.delete("shipment_id = 'SH-1002' AND status = 'In Transit'")
    assert table.current().count() == 4 and table.as_of(2).count() == 5 and table.as_of(1).count() == 3
    snaps = versions.snapshots(table.commits(), flat=True).orderBy("snapshot_id").collect()
    assert [(r["added_records"], r["deleted_records"], r["total_records"]) for r in snaps] == [(3, 0, 3), (2, 0, 5), (0, 1, 4)]


def test_empty_log(spark):
    schema = "k string, _row_id string, _commit_id long, _op string"
    log = spark.createDataFrame([], schema)
    assert versions.current(log).count() == 0 and versions.current(log).columns == ["k"]
    assert versions.recorded(log, F.lit(None).cast("timestamp_ntz")).count() == 0


def test_empty_text_partition_and_number_of_files(spark, tmp_dir):
    rows = [(i, ["", "a", None, "b"][i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, origin string").repartition(20)
    layout = evolve.Layout(f"{tmp_dir}/layout", ("origin",))
    evolve.write_layout(df, layout)
    back = evolve.read_layouts(spark, [layout], df.schema)
    assert sorted((r["i"], str(r["origin"])) for r in back.collect()) == sorted((i, str(o)) for i, o in rows)
    assert back.where("origin = ''").count() == 100 and back.where("origin IS NULL").count() == 100
    files = spark.read.parquet(layout.path).select(F.input_file_name()).distinct().count()
    assert files <= 8
