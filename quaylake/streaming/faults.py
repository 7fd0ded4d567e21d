"""Fault injection for recovery drills: the states that a crash leaves behind.

A micro-batch is written in this order: its entry in the checkpoint's
``offsets``, the data files, the sink's manifest entry (``_spark_metadata``), the
entry in ``commits``. Taking the last entries away puts a stopped query where a
crash between two of these steps would have left it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _drop_last_entry(spark: SparkSession, folder: str) -> int:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    last = max(int(n.removesuffix(".compact")) for n in names if n[0].isdigit())
    for n in names:
        if n in (str(last), f"{last}.compact"):
            fs.delete(sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}"), False)
    return last


def lose_commit(spark: SparkSession, checkpoint: str) -> int:
    """As after a crash between the sink's manifest entry and the commit of the last
    batch; returns its number."""
    return _drop_last_entry(spark, f"{checkpoint}/commits")


def lose_manifest(spark: SparkSession, checkpoint: str, sink: str) -> int:
    """As after a crash between the data files and the manifest entry of the last
    batch: its files lie in the sink, nothing knows them."""
    batch = lose_commit(spark, checkpoint)
    if _drop_last_entry(spark, f"{sink}/_spark_metadata") != batch:
        raise RuntimeError(f"the sink's last batch is not {batch}")
    return batch
