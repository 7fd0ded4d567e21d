"""Operational KPIs, breakdowns and the recent-shipments list, computed in the
plan so only the aggregated rows leave the cluster.

Null rules follow the dashboard semantics: a missing column gives the
default (0 / 0.0), NULL (and NaN) values are skipped, NULL group keys are
dropped, and a sum of no values is 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions.timeparse import parse_event_time


def _numeric(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col


def kpi_summary(df: DataFrame) -> DataFrame:
    """Total rows, total revenue, mean weight and distinct vehicles."""
    cols = set(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("total_shipments"),
        (F.coalesce(F.sum(_numeric(df, "revenue")), F.lit(0.0)) if "revenue" in cols else F.lit(0.0)).alias(
            "total_revenue"
        ),
        (F.avg(_numeric(df, "weight")) if "weight" in cols else F.lit(0.0)).alias("avg_weight"),
        (F.count_distinct("vehicle_id") if "vehicle_id" in cols else F.lit(0).cast("long")).alias("unique_vehicles"),
    )


def kpi_display(summary: DataFrame) -> DataFrame:
    """Display text of the KPI row: thousands separators, two decimals."""
    return summary.select(
        F.format_number("total_shipments", 0).alias("total_shipments_text"),
        F.concat(F.lit("$"), F.format_number("total_revenue", 2)).alias("total_revenue_text"),
        F.concat(F.regexp_replace(F.format_number("avg_weight", 2), ",", ""), F.lit(" kg")).alias("avg_weight_text"),
        F.col("unique_vehicles").cast("string").alias("unique_vehicles_text"),
    )


def revenue_by_destination(df: DataFrame) -> DataFrame:
    """Revenue summed per destination in its order, NULL destinations dropped."""
    if "destination" not in df.columns or "revenue" not in df.columns:
        return df.sparkSession.createDataFrame([], "destination string, revenue double")
    return (
        df.where(F.col("destination").isNotNull())
        .groupBy("destination")
        .agg(F.coalesce(F.sum(_numeric(df, "revenue")), F.lit(0.0)).alias("revenue"))
        .orderBy("destination")
    )


def is_empty(df: DataFrame) -> DataFrame:
    """One row: ``is_empty``. At most one row per task is looked at."""
    return df.select(F.lit(1).alias("_one")).limit(1).agg((F.count("_one") == 0).alias("is_empty"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value of ``column``, most frequent first."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"{column} string, count long")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
    )


def priority_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, "priority")


def status_breakdown(df: DataFrame) -> DataFrame:
    return value_counts(df, "status")


def recent_shipments(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` latest rows by parsed event time (unparsable last), ties by
    shipment id. Planned as a per-partition top-k (TakeOrderedAndProject)."""
    ts = parse_event_time(F.col("timestamp")) if "timestamp" in df.columns else F.lit(None).cast("timestamp_ntz")
    return (
        df.withColumn("event_time", ts)
        .orderBy(F.col("event_time").desc_nulls_last(), F.col("shipment_id").asc_nulls_last())
        .limit(n)
    )


BREAKDOWN_DIMENSIONS = ("destination", "priority", "status")


def breakdowns(df: DataFrame, dimensions=BREAKDOWN_DIMENSIONS) -> DataFrame:
    """All dashboard breakdowns and the totals from one scan and one shuffle.

    One grouping-sets aggregate (one set per dimension plus the empty set) with
    map-side partial aggregation; output rows: dimension, key, rows, revenue.
    NULL keys are dropped per dimension; the ``all`` row holds the totals.
    """
    dims = [d for d in dimensions if d in df.columns]
    n = len(dims)
    revenue = F.coalesce(F.sum(_numeric(df, "revenue")), F.lit(0.0)) if "revenue" in df.columns else F.lit(0.0)
    grouped = df.groupingSets([[d] for d in dims] + [[]], *dims).agg(
        F.count(F.lit(1)).alias("rows"), revenue.alias("revenue"), F.grouping_id().alias("_gid")
    )
    dimension = F.lit("all")
    for i, d in reversed(list(enumerate(dims))):
        only_d = (1 << n) - 1 - (1 << (n - 1 - i))  # every other dimension aggregated away
        dimension = F.when(F.col("_gid") == only_d, F.lit(d)).otherwise(dimension)
    key = F.coalesce(*[F.col(d).cast("string") for d in dims]) if dims else F.lit(None).cast("string")
    return (
        grouped.select(dimension.alias("dimension"), key.alias("key"), "rows", "revenue")
        .where((F.col("dimension") == "all") | F.col("key").isNotNull())
    )
