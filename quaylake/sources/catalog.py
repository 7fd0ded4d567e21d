"""Catalog DDL through Spark SQL: databases and tables from one declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str = "parquet",
    location: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """CREATE TABLE IF NOT EXISTS with the declared schema (``fmt`` may be a
    table format whose connector is on the class path, e.g. ``iceberg``)."""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(schema)}) USING {fmt}{parts}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """True when the table resolves; any catalog failure counts as absent."""
    try:
        return bool(spark.catalog.tableExists(name))
    except Exception:  # noqa: BLE001
        return False


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, location: str) -> None:
    """A table of ``buckets`` files, each sorted by the keys. Rows are dealt as the
    buckets are, so a task writes one of them."""
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = dealt.write.mode("overwrite").option("path", location)
    writer.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).saveAsTable(table)
