"""Run a rule suite over a batch: annotate rows, summarise rules, split.

NaN counts as missing everywhere, for uniqueness as well. A uniqueness rule
runs jobs when ``annotate`` is called: its duplicate keys are stored and
measured to choose the join.

Plan shape: one scan, one ``Project`` of per-rule fail flags and one key
aggregation per uniqueness rule (partial aggregation, then a join against the
duplicate-key set, broadcast only when measured small). Rule statistics and
batch statistics are single global aggregates over the annotated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.operators.quality.rules import UNIQUE, Rule
from quaylake.plans.broadcast import join_small

FAILURES = "dq_failures"
REASONS = "quarantine_reasons"
_INTERNAL = "_dq_"


def _fail_col(i: int) -> str:
    return f"{_INTERNAL}fail_{i}"


def _nan_to_null(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col


def value_text(col: Column) -> Column:
    """Failing value as text; a missing one (NULL, NaN) renders as ``None``."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def any_failed(annotated: DataFrame) -> Column:
    """Whether a row fails some rule, from the boolean flags."""
    out = F.lit(False)
    for c in annotated.columns:
        if c.startswith(f"{_INTERNAL}fail_"):
            out = out | F.col(f"`{c}`")
    return out


def payload_columns(annotated: DataFrame) -> list[str]:
    return [c for c in annotated.columns if not c.startswith(_INTERNAL) and c != FAILURES]


def annotate(df: DataFrame, rules: Sequence[Rule], max_broadcast_bytes: int | None = None) -> DataFrame:
    """Add one boolean fail flag per rule and ``dq_failures``, the array of
    failed rules of the row in suite order (rule, column, expectation, value)."""
    for i, rule in enumerate(rules):
        if rule.column not in df.columns:
            raise AnalysisException(f"rule {i} ({rule.expectation}) needs column {rule.column!r}, which the batch lacks")
    out = df
    dup_flags: dict[int, Column] = {}
    for i, rule in enumerate(rules):
        if rule.expectation != UNIQUE:
            continue
        flag, key = f"{_INTERNAL}dup_{i}", f"{_INTERNAL}key_{i}"
        # duplicate keys only: partial aggregation keeps the shuffle to one row
        # per key and map task, so a hot key does not reach one task whole
        keyed = df.select(_nan_to_null(df, rule.column).alias(key))
        dups = (
            keyed.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
            .select(key, F.lit(True).alias(flag))
        )
        out = out.withColumn(key, _nan_to_null(df, rule.column))
        out = join_small(out, dups, on=key, how="left", max_bytes=max_broadcast_bytes)
        dup_flags[i] = F.col(flag)
    # a join by name moves its key to the front: the batch's own order again
    internal = [c for c in out.columns if c.startswith(f"{_INTERNAL}dup_")]
    out = out.select(*[F.col(f"`{c}`") for c in df.columns], *internal)

    flags = {}
    for i, rule in enumerate(rules):
        value = _nan_to_null(out, rule.column)
        flags[_fail_col(i)] = rule.fail(value, dup_flags.get(i))
    out = out.withColumns(flags)

    entries = [
        F.when(
            F.col(_fail_col(i)),
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(rule.column).alias("column"),
                F.lit(rule.expectation).alias("expectation"),
                value_text(_nan_to_null(out, rule.column)).alias("value"),
            ),
        )
        for i, rule in enumerate(rules)
    ]
    out = out.withColumn(FAILURES, F.array_compact(F.array(*entries)))
    return out.drop(*[c for c in out.columns if c.startswith(f"{_INTERNAL}dup_")])


def reasons_text(failures: Column) -> Column:
    """``"<column> failed <expectation> (value: <value>)"`` joined by ``", "``."""
    return F.array_join(
        F.transform(
            failures,
            lambda x: F.concat(x["column"], F.lit(" failed "), x["expectation"], F.lit(" (value: "), x["value"], F.lit(")")),
        ),
        ", ",
    )


def clean_rows(annotated: DataFrame) -> DataFrame:
    """Rows that fail no rule, with the input columns only."""
    return annotated.where(~any_failed(annotated)).select(*[F.col(f"`{c}`") for c in payload_columns(annotated)])


def quarantine_rows(annotated: DataFrame) -> DataFrame:
    """Rows that fail at least one rule, plus their reasons."""
    return annotated.where(any_failed(annotated)).select(
        *[F.col(f"`{c}`") for c in payload_columns(annotated)], reasons_text(F.col(FAILURES)).alias(REASONS)
    )


def reasons_long(annotated: DataFrame) -> DataFrame:
    """One row per (row, failed rule)."""
    cols = [F.col(f"`{c}`") for c in payload_columns(annotated)]
    return annotated.where(any_failed(annotated)).select(*cols, F.explode(FAILURES).alias("_f")).select(
        *cols,
        F.col("_f.rule").alias("rule_index"),
        F.col("_f.column").alias("rule_column"),
        F.col("_f.expectation").alias("expectation"),
        F.col("_f.value").alias("value"),
        F.concat(
            F.col("_f.column"), F.lit(" failed "), F.col("_f.expectation"), F.lit(" (value: "), F.col("_f.value"), F.lit(")")
        ).alias("reason"),
    )


def rule_failures(annotated: DataFrame, rules: Sequence[Rule], index: int) -> DataFrame:
    """Rows failing rule ``index`` with the reason for that rule."""
    rule = rules[index]
    return annotated.where(F.col(_fail_col(index))).select(
        *[F.col(f"`{c}`") for c in payload_columns(annotated)],
        F.concat(
            F.lit(f"{rule.column} failed {rule.expectation} (value: "),
            value_text(_nan_to_null(annotated, rule.column)),
            F.lit(")"),
        ).alias("reason"),
    )


def rule_stats(annotated: DataFrame, rules: Sequence[Rule], with_kwargs: bool = False) -> DataFrame:
    """One row per rule, from a single global aggregate over the batch:
    element, missing and unexpected counts, unexpected percent and success."""
    aggs = [F.count(F.lit(1)).alias("element_count")]
    for i, rule in enumerate(rules):
        aggs.append(F.count_if(F.col(_fail_col(i))).alias(f"u{i}"))
        aggs.append(F.count(_nan_to_null(annotated, rule.column)).alias(f"nn{i}"))
    wide = annotated.agg(*aggs)
    per_rule = []
    for i, rule in enumerate(rules):
        fields = [
            F.lit(i).alias("rule_index"),
            F.lit(rule.column).alias("rule_column"),
            F.lit(rule.expectation).alias("expectation"),
            (F.col("element_count") - F.col(f"nn{i}")).alias("missing_count"),
            F.col(f"u{i}").alias("unexpected_count"),
            (F.col("element_count") if rule.counts_nulls else F.col(f"nn{i}")).alias("base"),
        ]
        if with_kwargs:
            kv = rule.kwargs()
            fields.append(F.create_map(*[F.lit(x) for pair in kv.items() for x in pair]).alias("kwargs"))
        per_rule.append(F.struct(*fields))
    base = F.col("base").cast("double")
    out = wide.select("element_count", F.inline(F.array(*per_rule))).select(
        "rule_index",
        "rule_column",
        "expectation",
        (F.col("unexpected_count") == 0).alias("success"),
        "element_count",
        "missing_count",
        "unexpected_count",
        F.when(base > 0, F.col("unexpected_count").cast("double") / base * F.lit(100.0)).alias("unexpected_percent"),
        *(["kwargs"] if with_kwargs else []),
    )
    return out


def batch_stats(annotated: DataFrame, clean: Column | None = None) -> DataFrame:
    """One row: total, clean, quarantine and success rate in percent (0 when
    the batch is empty). ``clean``: what tells a clean row, if not the flags."""
    agg = annotated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~any_failed(annotated) if clean is None else clean).alias("clean"),
    )
    total = F.col("total")
    return agg.select(
        "total",
        "clean",
        (total - F.col("clean")).alias("quarantine"),
        F.when(total > 0, F.col("clean").cast("double") / total.cast("double") * F.lit(100.0))
        .otherwise(F.lit(0.0))
        .alias("success_rate"),
    )
