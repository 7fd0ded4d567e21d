"""Load gate on the batch success rate, and the gated load of clean rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_THRESHOLD = 85.0  # percent of clean rows required to load


def gate(batch_stats: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Batch stats plus the threshold and the decision ``INGEST`` or ``STOP``."""
    return batch_stats.select(
        "*",
        F.lit(float(threshold)).alias("threshold"),
        F.when(F.col("success_rate") >= F.lit(float(threshold)), F.lit("INGEST")).otherwise(F.lit("STOP")).alias("decision"),
    )


def gated_rows(clean: DataFrame, batch_stats: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The clean rows when the gate passes, no rows otherwise.

    The decision is a scalar subquery over the one-row stats, so the filter
    stays in the plan and nothing is collected to the driver.
    """
    passes = batch_stats.select((F.col("success_rate") >= F.lit(float(threshold))).alias("ok")).scalar()
    return clean.where(F.coalesce(passes, F.lit(False)))


def gated_load(
    clean: DataFrame,
    batch_stats: DataFrame,
    target_path: str,
    threshold: float = DEFAULT_THRESHOLD,
    fmt: str = "parquet",
    batch_id: str = "1",
) -> bool:
    """Write the clean rows to the batch's own folder of ``target_path`` only if
    the gate passes. A load that is run again replaces what it wrote before.

    Returns whether the load ran. Only the one-row decision is read back.
    """
    row = gate(batch_stats, threshold).select("decision").first()
    if row is None or row["decision"] != "INGEST":
        return False
    clean.write.mode("overwrite").format(fmt).save(f"{target_path}/batch_id={batch_id}")
    return True
