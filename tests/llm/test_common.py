"""Partitions of stored tables: few for small ones, never fewer for large ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaylake.llm import common


def parts(df):
    return df.rdd.getNumPartitions()


def test_known_rows_decide(spark):
    df = spark.range(0, 1000, 1, 40)
    assert parts(common.fewer(df, 1000)) == 1
    assert parts(common.fewer(df, 5 * common.ROWS_PER_FILE + 1)) == 6
    assert parts(common.fewer(df, 10**12)) == 40


def test_planned_bytes_decide(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 1 << 20, 1, 6 * cores)  # 8 MB
    assert parts(common.fewer(df)) == 4 * cores
    monkeypatch.setattr(common, "PLANNED_BYTES", 1024)
    assert parts(common.fewer(df)) == 6 * cores


def test_stored_tables_come_back(spark):
    df = spark.range(0, 100, 1, 9).withColumn("t", F.lit("é"))
    back = common.stored(df, "some")
    assert back.schema.simpleString() == df.schema.simpleString() and sorted(back.collect()) == sorted(df.collect())
