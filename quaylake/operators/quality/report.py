"""Report frames over the validation results: one row per check with its
criteria text, and the one-row header of totals, check counts and gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.operators.quality.gate import DEFAULT_THRESHOLD


def criteria_text(expectation: Column, kwargs: Column) -> Column:
    """``Expect <column> ...`` by expectation type and the min/max present."""
    # The texts below are shown to users as they stand.
    column = F.coalesce(kwargs["column"], F.lit("Dataset-Level"))
    lo, hi = kwargs["min_value"], kwargs["max_value"]
    tail = (
        F.when(expectation.contains("not_be_null"), F.lit("to contain no null values."))
        .when(expectation.contains("be_unique"), F.lit("to contain only unique values."))
        .when(
            expectation.contains("be_between"),
            F.when(lo.isNotNull() & hi.isNotNull(), F.concat(F.lit("to be between "), lo, F.lit(" and "), hi, F.lit(".")))
            .when(lo.isNotNull(), F.concat(F.lit("to be at least "), lo, F.lit(".")))
            .when(hi.isNotNull(), F.concat(F.lit("to be at most "), hi, F.lit(".")))
            .otherwise(F.lit("")),
        )
        .when(expectation.contains("match_regex"), F.lit("to match standard format."))
        .otherwise(F.concat(F.lit("to satisfy expectation "), expectation, F.lit(".")))
    )
    return F.concat(F.lit("Expect "), column, F.lit(" "), tail)


def report_checks(results: DataFrame) -> DataFrame:
    """``results``: one row per rule with rule_index, expectation, kwargs,
    success, unexpected_count, unexpected_percent (see ``results_io``)."""
    return results.select(
        (F.col("rule_index") + 1).alias("check_number"),
        F.coalesce(F.col("kwargs")["column"], F.lit("Dataset-Level")).alias("rule_column"),
        "expectation",
        criteria_text(F.col("expectation"), F.col("kwargs")).alias("criteria"),
        F.when(F.col("success"), F.lit("Passed")).otherwise(F.lit("Failed")).alias("status"),
        F.coalesce(F.col("unexpected_count"), F.lit(0)).cast("long").alias("unexpected_count"),
        F.coalesce(F.col("unexpected_percent"), F.lit(0.0)).alias("unexpected_percent"),
    )


def report_summary(results: DataFrame, batch_stats: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: row totals from the batch, passed/failed checks and the
    element count of the first result that has one, plus the gate."""
    checks = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("success")).alias("passed_checks"),
        F.min_by(F.col("element_count"), F.when(F.col("element_count").isNotNull(), F.col("rule_index"))).alias(
            "row_count"
        ),
    )
    # the two one-row aggregates meet in one final aggregate over their union:
    # each input is computed once, with no join and no repeated subquery
    batch = batch_stats.select("total", "clean", "quarantine", "success_rate")
    one = batch.unionByName(checks, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in batch.columns + checks.columns]
    )
    rate = F.col("success_rate")
    return one.select(
        F.col("total").alias("total_rows"),
        F.col("clean").alias("clean_rows"),
        F.col("quarantine").alias("quarantine_rows"),
        rate.alias("success_rate"),
        (F.lit(100.0) - rate).alias("quarantine_rate"),
        F.lit(float(threshold)).alias("threshold"),
        F.when(rate >= F.lit(float(threshold)), F.lit("Ingestion Allowed"))
        .otherwise(F.lit("Pipeline Stopped"))
        .alias("gate_status"),
        F.col("total_checks"),
        F.col("passed_checks"),
        (F.col("total_checks") - F.col("passed_checks")).alias("failed_checks"),
        F.coalesce(F.col("row_count"), F.lit(0)).cast("long").alias("row_count"),
    )
