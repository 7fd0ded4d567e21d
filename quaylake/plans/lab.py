"""Written tables behind the table-operation queries.

Each is built once per Spark application and scale-factor folder under the
shared checkpoint folder (``spark.checkpoint.dir``), then read back by the
queries: a plain shipments table, a log of shipment versions with its commits,
and a table whose partition layout changed half way. ``prepare`` builds all.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.operators import kpi_parts, versions
from quaylake.operators.evolve import Layout, write_layout
from quaylake.schemas import LOG_COMMIT_ID, LOG_OP, LOG_ROW_ID, SHIPMENT_SCHEMA
from quaylake.session import scratch_path
from quaylake.sources import catalog as ddl
from quaylake.sources import fixtures

_LOCK = threading.RLock()
_BUILT: dict[tuple[str, str, str], object] = {}

# Fixed values of the versioned-table scenario.
AS_OF_MONTH = 1995 * 12 + 6  # commit of June 1995
UPDATE_PREDICATE = "priority = 'High' AND status = 'In Transit'"
UPDATE_SET = {"status": "'Out for Delivery'"}
DELETE_PREDICATE = "status = 'Delivered'"
LAYOUT_CUTOVER = "1998-01-01"  # rows before it were written unpartitioned


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote session
        return str(spark.conf.get("spark.app.id", id(spark)))


def _memo(spark: SparkSession, sf_dir: str, name: str, build):
    key = (_app_id(spark), sf_dir, name)
    with _LOCK:
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]


def shipments_table(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "shipments")
        fixtures.shipments(spark, sf_dir).write.mode("overwrite").parquet(path)
        return path

    return _memo(spark, sf_dir, "shipments", build)


def read_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SHIPMENT_SCHEMA).parquet(shipments_table(spark, sf_dir))


def shipment_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A log of shipment versions and its commits, one commit per month (numbered
    year * 12 + month): a shipment enters in the month of its order, a High one
    in transit is sent out for delivery a month later, a delivered one leaves
    two months later."""

    def build() -> tuple[str, str]:
        ships = read_shipments(spark, sf_dir).where(F.col("timestamp").isNotNull())
        year, month = (F.substring("timestamp", *at).cast("long") for at in ((1, 4), (6, 2)))
        entered = ships.withColumn(LOG_ROW_ID, F.col("shipment_id")).withColumn(LOG_COMMIT_ID, year * 12 + month)
        later = lambda df, months, op: df.withColumn(LOG_COMMIT_ID, F.col(LOG_COMMIT_ID) + months).withColumn(LOG_OP, F.lit(op))
        sent = entered.where(UPDATE_PREDICATE).withColumn("status", F.expr(UPDATE_SET["status"]))
        log = later(entered, 0, "I").unionByName(later(sent, 1, "U")).unionByName(later(entered.where(DELETE_PREDICATE), 2, "D"))
        log_path, commits_path = scratch_path(spark, "version-log"), scratch_path(spark, "version-commits")
        log.write.parquet(log_path)
        number = F.col("commit_id") - 1
        at = F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1)).cast("timestamp_ntz")
        versions.recorded(spark.read.parquet(log_path), at).coalesce(1).write.parquet(commits_path)
        return log_path, commits_path

    log, commits = _memo(spark, sf_dir, "version-log", build)
    return spark.read.parquet(log), spark.read.parquet(commits)


def evolved_layouts(spark: SparkSession, sf_dir: str) -> list[Layout]:
    """Old rows in an unpartitioned root, later rows in a root partitioned by
    origin."""

    def build() -> list[Layout]:
        base = scratch_path(spark, "layouts")
        old, new = Layout(f"{base}/v1"), Layout(f"{base}/v2", ("origin",))
        ships = read_shipments(spark, sf_dir)
        early = F.coalesce(F.col("timestamp") < F.lit(LAYOUT_CUTOVER), F.lit(False))
        write_layout(ships.where(early), old)
        write_layout(ships.where(~early), new)
        return [old, new]

    return _memo(spark, sf_dir, "layouts", build)


#: buckets of the bucketed table
BUCKETS = 16


def bucketed_shipments(spark: SparkSession, sf_dir: str) -> str:
    """A catalog table of the shipments, bucketed and sorted by their id."""

    def build() -> str:
        path = scratch_path(spark, "bucketed")
        table = f"quaylake_lab.{path.rsplit('/', 1)[1].replace('-', '_')}"
        ddl.ensure_database(spark, "quaylake_lab", scratch_path(spark, "lab"))
        ddl.write_bucketed(fixtures.shipments(spark, sf_dir), table, ["shipment_id"], BUCKETS, path)
        return table

    return _memo(spark, sf_dir, "bucketed", build)


def clustered_layouts(spark: SparkSession, sf_dir: str) -> list[Layout]:
    """As ``evolved_layouts``, the old root clustered by origin."""

    def build() -> list[Layout]:
        base = scratch_path(spark, "clustered")
        old, new = Layout(f"{base}/v1"), Layout(f"{base}/v2", ("origin",))
        ships = read_shipments(spark, sf_dir)
        early = F.coalesce(F.col("timestamp") < F.lit(LAYOUT_CUTOVER), F.lit(False))
        write_layout(ships.where(early), old, cluster_by=["origin"])
        write_layout(ships.where(~early), new)
        return [old, new]

    return _memo(spark, sf_dir, "clustered", build)


def kpi_part_table(spark: SparkSession, sf_dir: str) -> str:
    """KPI parts, one per day, of two loads (before and after the cut-over); the second
    adds the vehicles it brings to the dictionary of the first."""

    def build() -> str:
        path, words = scratch_path(spark, "kpi-parts"), scratch_path(spark, "kpi-vehicles")
        ships = read_shipments(spark, sf_dir)
        early = F.coalesce(F.col("timestamp") < F.lit(LAYOUT_CUTOVER), F.lit(False))
        known = None
        for load in (ships.where(early), ships.where(~early)):
            kpi_parts.number_values(load, "vehicle_id", known).write.mode("append").parquet(words)
            known = spark.read.parquet(words)
            kpi_parts.kpi_parts(load, F.substring("timestamp", 1, 10), known).write.mode("append").parquet(path)
        return path

    return _memo(spark, sf_dir, "kpi-parts", build)


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Build every table above."""
    shipments_table(spark, sf_dir)
    shipment_log(spark, sf_dir)
    evolved_layouts(spark, sf_dir)
    clustered_layouts(spark, sf_dir)
    bucketed_shipments(spark, sf_dir)
    kpi_part_table(spark, sf_dir)
