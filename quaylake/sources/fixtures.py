"""Deterministic views over the scale-factor tables.

``shipments`` and ``retail_orders`` are the inputs of the lakehouse and
data-quality operators; they are derived from ``orders`` (plus ``customer`` and
``nation``), so their size grows with the scale factor. The SQL text of each
view lives in ``quaylake.plans.oracle`` and is run there by DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.schemas import SHIPMENT_COLUMNS
from quaylake.sources.tables import read_table

# Fixed values of the fixture definitions.
HIGH_ORDER_PRIORITIES = ("1-URGENT", "2-HIGH")
STATUS_BY_ORDER_STATUS = {"F": "Delivered", "O": "In Transit"}
DEFAULT_STATUS = "Shipment Created"
LIFECYCLE = ["Shipment Created", "Vehicle Assigned", "In Transit", "Out for Delivery", "Delivered"]
AS_OF_DATE = "2001-06-30"  # data-quality cut-off replacing "today"


def _date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per order; origin from the order key, destination from
    the customer's nation."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dest = nation.select(F.col("n_nationkey").alias("dest_key"), F.col("n_name").alias("destination"))
    orig = nation.select(F.col("n_nationkey").alias("orig_key"), F.col("n_name").alias("origin"))

    key = F.col("o_orderkey")
    weight = (F.lit(10) + key % 1491).cast("double")
    high = F.col("o_orderpriority").isin(*HIGH_ORDER_PRIORITIES)
    status = F.col("o_orderstatus")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(dest, F.col("c_nationkey") == F.col("dest_key"))
        .join(orig, F.col("orig_key") == key % 25)
        .select(
            F.concat(F.lit("SH-"), key.cast("string")).alias("shipment_id"),
            "origin",
            "destination",
            F.concat(F.lit("V-"), (F.lit(100) + key % 201).cast("string")).alias("vehicle_id"),
            weight.alias("weight"),
            F.when(high, "High")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Medium")
            .otherwise("Low")
            .alias("priority"),
            (weight * F.when(high, F.lit(15.0)).otherwise(F.lit(10.0))).alias("revenue"),
            F.when(status == "F", STATUS_BY_ORDER_STATUS["F"])
            .when(status == "O", STATUS_BY_ORDER_STATUS["O"])
            .otherwise(DEFAULT_STATUS)
            .alias("status"),
            F.concat(_date_text(F.col("o_orderdate")), F.lit(" 00:00:00")).alias("timestamp"),
        )
    )


def retail_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A retail order batch with injected faults at fixed key residues."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return o.select(
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 50 == 0, F.concat(F.lit("ORD_"), (k + 1).cast("string")))
        .otherwise(F.concat(F.lit("ORD_"), k.cast("string")))
        .alias("order_id"),
        F.when(k % 61 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")))
        .alias("customer_id"),
        F.when(k % 41 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("PROD_"), (k % 200).cast("string")))
        .alias("product_id"),
        F.when(k % 37 == 0, F.lit(-2)).otherwise((F.lit(1) + k % 10).cast("int")).alias("quantity"),
        F.when(k % 43 == 0, -price).when(k % 83 == 0, F.lit(0.0)).otherwise(price).alias("price"),
        _date_text(F.col("o_orderdate")).alias("transaction_date"),
        F.when(k % 53 == 0, F.lit("john.doe@"))
        .when(k % 59 == 0, F.lit("test.com@test"))
        .when(k % 71 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@gmail.com")))
        .alias("customer_email"),
    )


def next_status(status: Column) -> Column:
    """One step along the shipment lifecycle; the last step stays."""
    expr = F.lit(LIFECYCLE[-1])
    for current, following in reversed(list(zip(LIFECYCLE, LIFECYCLE[1:]))):
        expr = F.when(status == current, F.lit(following)).otherwise(expr)
    return expr


def new_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new shipment ``SH-N<c_custkey>`` per customer."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orig = nation.select(F.col("n_nationkey").alias("orig_key"), F.col("n_name").alias("origin"))
    dest = nation.select(F.col("n_nationkey").alias("dest_key"), F.col("n_name").alias("destination"))
    ck = F.col("c_custkey")
    weight = (F.lit(10) + ck % 1491).cast("double")
    return (
        cust.join(orig, F.col("c_nationkey") == F.col("orig_key"))
        .join(dest, F.col("dest_key") == ck % 25)
        .select(
            F.concat(F.lit("SH-N"), ck.cast("string")).alias("shipment_id"),
            "origin",
            "destination",
            F.concat(F.lit("V-"), (F.lit(100) + ck % 201).cast("string")).alias("vehicle_id"),
            weight.alias("weight"),
            F.lit("Low").alias("priority"),
            (weight * F.lit(10.0)).alias("revenue"),
            F.lit(LIFECYCLE[0]).alias("status"),
            F.lit("2001-08-02 10:05:00").alias("timestamp"),
        )
    )


def merge_source(spark: SparkSession, sf_dir: str, target: DataFrame | None = None) -> DataFrame:
    """Incoming batch for MERGE: the next lifecycle event, at 10:00 the same
    day, of every shipment not yet delivered, plus the new shipments."""
    ships = target if target is not None else shipments(spark, sf_dir)
    updates = ships.where(F.col("status") != LIFECYCLE[-1]).select(
        *[
            next_status(F.col("status")).alias("status")
            if c == "status"
            else F.concat(F.substring("timestamp", 1, 10), F.lit(" 10:00:00")).alias("timestamp")
            if c == "timestamp"
            else F.col(c)
            for c in SHIPMENT_COLUMNS
        ]
    )
    return updates.unionByName(new_shipments(spark, sf_dir))


def duplicate_key_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge source whose unmatched keys repeat and whose keys may be NULL:
    the new shipments twice more, once with a NULL id."""
    base = merge_source(spark, sf_dir)
    fresh = new_shipments(spark, sf_dir)
    return base.unionByName(fresh).unionByName(fresh.withColumn("shipment_id", F.lit(None).cast("string")))
