"""DML traps, merge cardinality, JSON codec, streaming, CSV and KPIs."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quaylake.functions.events import CORRUPT, decode_events, encode_events, json_field
from quaylake.functions.shipments import derive_revenue
from quaylake.functions.timeparse import parse_event_time
from quaylake.operators import dml, kpis
from quaylake.plans.broadcast import join_small, measure
from quaylake.schemas import RETAIL_ORDER_SCHEMA, SHIPMENT_SCHEMA
from quaylake.sources import fixtures
from quaylake.sources.csv_io import read_csv, split_csv, write_csv
from quaylake.streaming.ingest import event_source, ingest_available, run_bounded, start_append

from .conftest import SF001, SF0001


def test_update_and_delete_null_predicate(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, s string")
    up = dml.update_where(df, "s = 'x'", {"s": "'z'"})
    assert sorted(tuple(r) for r in up.collect()) == [(1, None), (2, "z"), (3, "y")]
    kept = dml.delete_where(df, "s <> 'y'")
    assert sorted(r["k"] for r in kept.collect()) == [1, 3]  # NULL predicate keeps the row


def test_merge_null_keys_and_unmatched_duplicates_insert(spark, seed):
    src = spark.createDataFrame(
        [(None, "a"), (None, "b"), ("SH-9", "c"), ("SH-9", "d"), ("SH-1003", "e")], "shipment_id string, status string"
    )
    out = dml.merge_into(seed, src, "shipment_id", {"status": "status"})
    assert out.count() == 3 + 4
    assert out.where("shipment_id = 'SH-1003'").first()["status"] == "e"
    # without a matched clause the matched key is not inserted
    assert dml.merge_into(seed, src, "shipment_id", None).count() == 3 + 4


def test_merge_raises_on_duplicate_matching_source(spark, seed):
    src = spark.createDataFrame([("SH-1001", "a"), ("SH-1001", "b")], "shipment_id string, status string")
    out = dml.merge_into(seed, src, "shipment_id", {"status": "status"})
    with pytest.raises(Exception, match="more than one source row"):
        out.collect()
    with pytest.raises(Exception, match="more than one source row"):
        out.count()  # the check sits in a filter, so pruning cannot remove it


def test_merge_shuffle_path_equals_broadcast_path(spark):
    tgt = fixtures.shipments(spark, SF0001)
    src = fixtures.merge_source(spark, SF0001)
    upd = {"status": "status", "timestamp": "timestamp"}
    a = dml.merge_into(tgt, src, "shipment_id", upd)
    b = dml.merge_into(tgt, src, "shipment_id", upd, max_broadcast_bytes=0)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()


def test_measure_and_join_small(spark):
    df = spark.range(100).select(F.col("id"), F.lit("abc").alias("s"))
    m = measure(df)
    assert m.rows == 100 and m.bytes >= 100 * (8 + 3)
    big = spark.range(1000)
    joined = join_small(big, df, "id", "left_semi", max_bytes=0)
    assert joined.count() == 100


def test_encode_decode_round_trip(spark):
    ships = fixtures.shipments(spark, SF0001)
    back = decode_events(encode_events(ships), SHIPMENT_SCHEMA)
    assert back.exceptAll(ships).count() == 0 and ships.exceptAll(back).count() == 0


def test_decode_malformed_modes(spark):
    vals = spark.createDataFrame(
        [('{"shipment_id": "A", "weight": 1.5}',), ("not json",), ("",), ('{"shipment_id": "B", "weight": "12"}',)],
        "value string",
    )
    keep = decode_events(vals, SHIPMENT_SCHEMA).collect()
    assert len(keep) == 4
    assert sum(1 for r in keep if all(v is None for v in r)) == 2  # all-NULL rows appended
    assert [r["weight"] for r in keep if r["shipment_id"] == "B"] == [None]
    drop = decode_events(vals, SHIPMENT_SCHEMA, on_malformed="drop").collect()
    assert sorted(r["shipment_id"] for r in drop) == ["A"]  # a mistyped field marks the record corrupt
    quarantine = decode_events(vals, SHIPMENT_SCHEMA, on_malformed="quarantine")
    assert quarantine.count() == 4
    assert quarantine.where(F.col(CORRUPT).isNotNull()).count() == 3


def test_json_field(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    k = ev.select(json_field(F.col("props"), "k", "int").alias("k"))
    assert k.where("k IS NULL").count() == 0


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    ships = fixtures.shipments(spark, SF0001)
    src, sink, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    encode_events(ships).write.text(src)
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    first = spark.read.schema(SHIPMENT_SCHEMA).parquet(sink)
    assert first.exceptAll(ships).count() == 0 and ships.exceptAll(first).count() == 0
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    assert spark.read.schema(SHIPMENT_SCHEMA).parquet(sink).count() == ships.count()
    extra = fixtures.new_shipments(spark, SF0001)
    encode_events(extra).write.mode("append").text(src)
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    assert spark.read.schema(SHIPMENT_SCHEMA).parquet(sink).count() == ships.count() + extra.count()


def test_processing_time_trigger_bounded_run(spark, tmp_dir):
    ships = fixtures.shipments(spark, SF0001)
    src = f"{tmp_dir}/in"
    encode_events(ships).write.text(src)
    stream = decode_events(event_source(spark, fmt="text", path=src), SHIPMENT_SCHEMA)
    q = start_append(stream, f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out", trigger="1 second")
    q.processAllAvailable()
    run_bounded(q, timeout_s=1.0)
    assert not q.isActive
    assert spark.read.schema(SHIPMENT_SCHEMA).parquet(f"{tmp_dir}/out").count() == ships.count()


CSV_HEAD = "order_id,customer_id,product_id,quantity,price,transaction_date,customer_email\n"


def _csv(tmp_dir, name, text):
    with open(f"{tmp_dir}/{name}", "w") as f:
        f.write(text)
    return f"{tmp_dir}/{name}"


def test_csv_null_tokens_and_types(spark, tmp_dir):
    path = _csv(tmp_dir, "in.csv", CSV_HEAD + "ORD_1,NA,,#N/A,N/A,2001-01-01,None\nORD_2,CUST_2,PROD_2, 3,9.5,2001-01-02,a@b.co\n")
    rows = {r["order_id"]: r for r in read_csv(spark, path, RETAIL_ORDER_SCHEMA).collect()}
    assert rows["ORD_1"]["customer_id"] is None and rows["ORD_1"]["product_id"] is None
    assert rows["ORD_1"]["quantity"] is None and rows["ORD_1"]["price"] is None
    assert rows["ORD_1"]["customer_email"] is None
    assert rows["ORD_2"]["quantity"] == 3 and rows["ORD_2"]["price"] == 9.5


def test_csv_bad_records_are_kept_aside(spark, tmp_dir):
    bad = ["ORD_3,C,P,x,1.0,d,e", "ORD_4,C,P,1,1.0,d,e,more", "ORD_5,C,P"]
    path = _csv(tmp_dir, "bad.csv", CSV_HEAD + "ORD_2,C,P,3,9.5,d,e\n" + "\n".join(bad) + "\n")
    good, aside = split_csv(read_csv(spark, path, RETAIL_ORDER_SCHEMA, with_corrupt=True))
    assert [r["order_id"] for r in good.collect()] == ["ORD_2"] and good.columns == RETAIL_ORDER_SCHEMA.names
    assert {r["order_id"]: r["_corrupt_record"] for r in aside.collect()} == dict(zip(["ORD_3", "ORD_4", "ORD_5"], bad))
    with pytest.raises(Exception, match="bad CSV record"):
        read_csv(spark, path, RETAIL_ORDER_SCHEMA).collect()


def test_csv_columns_by_header_name(spark, tmp_dir):
    import os

    os.mkdir(f"{tmp_dir}/two")
    _csv(tmp_dir, "two/a.csv", CSV_HEAD + "ORD_1,CUST_1,P,1,1.0,d,e\n")
    _csv(tmp_dir, "two/b.csv", "customer_id,order_id,price,product_id,quantity,transaction_date,customer_email\nCUST_2,ORD_2,2.0,P,2,d,e\n")
    rows = read_csv(spark, f"{tmp_dir}/two", RETAIL_ORDER_SCHEMA, with_corrupt=True).collect()
    assert sorted((r["order_id"], r["customer_id"], r["price"], r["_corrupt_record"]) for r in rows) == [
        ("ORD_1", "CUST_1", 1.0, None),
        ("ORD_2", "CUST_2", 2.0, None),
    ]
    for head in ("order_id,price\n", CSV_HEAD.replace("price", "cost")):
        with pytest.raises(ValueError, match="header"):
            read_csv(spark, _csv(tmp_dir, "head.csv", head + "1,2\n"), RETAIL_ORDER_SCHEMA)


def test_csv_sink_loses_nothing(spark, tmp_dir):
    schema = "a string, n int, b string"
    rows = [("  pad ", 1, "x,y"), ("", 2, None), (None, None, ""), ("li\nne", 3, 'q"q"'), ('He said "hi", ok', 4, " "), ('"', 5, "\\")]
    df = spark.createDataFrame(rows, schema)
    write_csv(df.repartition(3), f"{tmp_dir}/odd")
    back = read_csv(spark, f"{tmp_dir}/odd", df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    write_csv(df.limit(0), f"{tmp_dir}/none")
    assert read_csv(spark, f"{tmp_dir}/none", df.schema).count() == 0


def test_insert_and_merge_find_columns_by_name(spark):
    table = spark.createDataFrame([("a", 1, "x")], "id string, n int, status string")
    rows = spark.createDataFrame([("Y", "b", 2.0)], "STATUS string, Id string, N double")
    out = dml.insert_append(table, rows)
    assert out.schema == table.schema and sorted(map(tuple, out.collect())) == [("a", 1, "x"), ("b", 2, "Y")]
    merged = dml.merge_into(table, rows.unionByName(spark.createDataFrame([("Z", "a", 5.0)], rows.schema)), "ID", {"Status": "status"})
    assert merged.schema == table.schema and sorted(map(tuple, merged.collect())) == [("a", 1, "Z"), ("b", 2, "Y")]
    with pytest.raises(ValueError, match="lacks"):
        dml.insert_append(table, rows.withColumn("other", F.lit(1)))
    with pytest.raises(ValueError, match="lacks"):
        dml.merge_into(table, rows, "id", {"other": "status"})
    with pytest.raises(ValueError, match="more than once"):
        dml.insert_append(table, rows.selectExpr("Id", "Id AS ID", "N"))


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_map_columns_on_both_join_paths(spark, max_bytes):
    schema = "id string, m map<string,int>, s struct<m: map<string,int>>"
    df = spark.createDataFrame([("a", {"x": 1}, None), ("a", {}, None), ("b", None, None), (None, {"y": 2}, None)], schema)
    from quaylake.operators.quality import validate as V
    from quaylake.operators.quality.rules import unique

    assert V.batch_stats(V.annotate(df, [unique("id")], max_bytes)).first()["quarantine"] == 2
    out = dml.merge_into(df, spark.createDataFrame([("b", {"n": 9}, None), ("c", {}, None)], schema), "id", {"m": "m"}, max_broadcast_bytes=max_bytes)
    assert {r["id"]: r["m"] for r in out.where("id IN ('b', 'c')").collect()} == {"b": {"n": 9}, "c": {}}
    assert out.count() == 5


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_merge_evaluates_its_source_once(spark, max_bytes):
    target = spark.range(40).selectExpr("id", "0D AS v")
    source = spark.range(20, 60).selectExpr("id").withColumn("v", F.rand()).where("v < 0.5")
    rows = dml.merge_into(target, source, "id", {"v": "v"}, max_broadcast_bytes=max_bytes).collect()
    ids = [r["id"] for r in rows]
    assert len(ids) == len(set(ids)) and set(range(40)) <= set(ids)


def test_json_keeps_null_fields(spark):
    df = spark.createDataFrame([(None, 1)], "a string, b int")
    assert encode_events(df).first()["value"] == '{"a":null,"b":1}'


def test_event_time_ignores_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("bad",), (None,), ("2024-03-10T02:30:00",)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = [r[0] for r in df.select(parse_event_time(F.col("t")).cast("string")).collect()]
            assert got == ["2024-03-10 02:30:00", None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_kpis_null_rules(spark):
    df = spark.createDataFrame(
        [("A", None, float("nan"), "V-1", "High", "x", "2001-01-01 00:00:00"),
         ("B", "Pune", 2.0, None, None, "y", "bad time"),
         ("C", "Pune", 4.0, "V-1", "Low", "y", "2001-01-02 00:00:00")],
        "shipment_id string, destination string, weight double, vehicle_id string, priority string, status string, "
        "timestamp string",
    ).withColumn("revenue", F.col("weight") * 10)
    s = kpis.kpi_summary(df).first()
    assert s["total_shipments"] == 3 and s["unique_vehicles"] == 1
    assert s["avg_weight"] == pytest.approx(3.0) and s["total_revenue"] == pytest.approx(60.0)
    by_dest = {r["destination"]: r["revenue"] for r in kpis.revenue_by_destination(df).collect()}
    assert by_dest == {"Pune": 60.0}
    pri = kpis.priority_distribution(df).collect()
    assert sorted((r["priority"], r["count"]) for r in pri) == [("High", 1), ("Low", 1)]
    recent = [r["shipment_id"] for r in kpis.recent_shipments(df, 20).collect()]
    assert recent == ["C", "A", "B"]  # unparsable time sorts last
    missing = kpis.kpi_summary(df.drop("revenue", "weight", "vehicle_id")).first()
    assert (missing["total_revenue"], missing["avg_weight"], missing["unique_vehicles"]) == (0.0, 0.0, 0)
    empty = kpis.kpi_summary(df.limit(0)).first()
    assert empty["total_shipments"] == 0 and empty["total_revenue"] == 0.0 and empty["avg_weight"] is None
    disp = kpis.kpi_display(kpis.kpi_summary(fixtures.shipments(spark, SF001))).first()
    assert disp["total_shipments_text"] == "15,000"
    assert disp["total_revenue_text"] == "$135,178,130.00"
    assert disp["avg_weight_text"] == "750.80 kg"


def test_derive_revenue(spark):
    df = spark.createDataFrame([(100.0, "High"), (100.0, "Low"), (None, "High")], "w double, p string")
    out = [r[0] for r in df.select(derive_revenue(F.col("w"), F.col("p"))).collect()]
    assert out == [1500.0, 1000.0, None]


def test_top_k_plan_is_take_ordered(spark):
    plan = kpis.recent_shipments(fixtures.shipments(spark, SF0001))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_breakdowns_equal_separate_frames(spark):
    ships = fixtures.shipments(spark, SF0001)
    b = kpis.breakdowns(ships)
    rev = {r["key"]: r["revenue"] for r in b.where("dimension = 'destination'").collect()}
    assert rev == {r["destination"]: r["revenue"] for r in kpis.revenue_by_destination(ships).collect()}
    pri = {r["key"]: r["rows"] for r in b.where("dimension = 'priority'").collect()}
    assert pri == {r["priority"]: r["count"] for r in kpis.priority_distribution(ships).collect()}
    st = {r["key"]: r["rows"] for r in b.where("dimension = 'status'").collect()}
    assert st == {r["status"]: r["count"] for r in kpis.status_breakdown(ships).collect()}
    total = b.where("dimension = 'all'").first()
    summary = kpis.kpi_summary(ships).first()
    assert total["rows"] == summary["total_shipments"] and total["revenue"] == summary["total_revenue"]
