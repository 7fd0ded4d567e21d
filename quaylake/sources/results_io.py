"""Validation results document: nested JSON sink and source.

The document is one JSON object ``{success, results: [...]}`` with one
element per rule in suite order. It is assembled from the rule-statistics
frame, whose size is the number of rules (not rows), so gathering it into one
array is bounded by the suite.

``read_results`` reads the fields a report uses under a declared schema.
``read_arguments`` reads the document as a VARIANT, so that rules may have any
arguments, nested ones too: one row for each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.schemas import RESULTS_DOCUMENT_SCHEMA


def results_document(stats_with_kwargs: DataFrame) -> DataFrame:
    """One-row document from ``validate.rule_stats(..., with_kwargs=True)``."""
    element = F.struct(
        F.col("success"),
        F.struct(F.col("expectation").alias("type"), F.col("kwargs")).alias("expectation_config"),
        F.struct(
            F.col("element_count").cast("long").alias("element_count"),
            F.col("missing_count").cast("long").alias("missing_count"),
            F.col("unexpected_count").cast("long").alias("unexpected_count"),
            F.col("unexpected_percent").alias("unexpected_percent"),
        ).alias("result"),
    )
    by_index = F.collect_list(F.struct(F.col("rule_index"), element.alias("e")))
    ordered = F.array_sort(
        by_index,
        lambda a, b: F.when(a["rule_index"] < b["rule_index"], -1).when(a["rule_index"] > b["rule_index"], 1).otherwise(0),
    )
    return stats_with_kwargs.agg(
        F.bool_and("success").alias("success"),
        F.transform(ordered, lambda x: x["e"]).alias("results"),
    )


def write_results(doc: DataFrame, path: str) -> None:
    doc.coalesce(1).write.mode("overwrite").json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per result, in document order, with the fields the report
    uses flattened: rule_index, success, expectation, kwargs, counts."""
    doc = spark.read.schema(RESULTS_DOCUMENT_SCHEMA).json(path)
    return doc.select(F.posexplode("results").alias("rule_index", "r")).select(
        "rule_index",
        F.col("r.success").alias("success"),
        F.col("r.expectation_config.type").alias("expectation"),
        F.col("r.expectation_config.kwargs").alias("kwargs"),
        F.col("r.expectation_config.kwargs")["column"].alias("rule_column"),
        F.col("r.result.element_count").alias("element_count"),
        F.col("r.result.missing_count").alias("missing_count"),
        F.col("r.result.unexpected_count").alias("unexpected_count"),
        F.col("r.result.unexpected_percent").alias("unexpected_percent"),
    )


def read_arguments(spark: SparkSession, path: str) -> DataFrame:
    """One row per result and argument: ``rule_index``, ``expectation``, ``argument``,
    ``kind`` (its type in the document) and ``value`` as text (JSON where it is
    nested). A result without arguments has one row with NULL ones."""
    doc = spark.read.option("singleVariantColumn", "doc").json(path)
    elements = doc.select(F.variant_get("doc", "$.results", "variant").alias("all"))
    elements = elements.lateralJoin(spark.tvf.variant_explode(F.col("all").outer()))
    config = F.variant_get("value", "$.expectation_config.kwargs", "variant")
    results = elements.select(
        F.col("pos").alias("rule_index"),
        F.variant_get("value", "$.expectation_config.type", "string").alias("expectation"),
        # an argument of its own keeps results without any
        F.coalesce(config, F.parse_json(F.lit("{}"))).alias("arguments"),
    )
    each = results.lateralJoin(spark.tvf.variant_explode_outer(F.col("arguments").outer()))
    nested = F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)")
    text = F.when(nested, F.to_json("value")).otherwise(F.try_variant_get("value", "$", "string"))
    return each.select(
        "rule_index", "expectation", F.col("key").alias("argument"), F.lower(F.schema_of_variant("value")).alias("kind"), text.alias("value")
    )
