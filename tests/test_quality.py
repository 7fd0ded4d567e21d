"""Data-quality rules: null semantics, uniqueness, reasons, split properties,
statistics, gate, report and the written validation run."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quaylake.operators.quality import report
from quaylake.operators.quality import validate as V
from quaylake.operators.quality.gate import gate, gated_load, gated_rows
from quaylake.operators.quality.rules import EMAIL_REGEX, between, match_regex, not_null, retail_suite, unique
from quaylake.operators.quality.run import validate_batch
from quaylake.schemas import RETAIL_ORDER_SCHEMA
from quaylake.sources import fixtures

from .conftest import SF001

ROWS = [
    ("ORD_1", "CUST_1", "PROD_1", 2, 10.0, "2001-01-01", "a.b@x.com"),
    ("ORD_1", "CUST_2", "PROD_2", 1, 0.0, "2001-01-02", "john.doe@"),  # dup id, price, email
    (None, None, "PROD_3", 0, float("nan"), "2001-07-01", None),  # null id, cust, qty, NaN price, date
    ("ORD_3", "CUST_3", None, 5, -3.5, "2001-06-30", "test.com@test"),
    ("ORD_4", "CUST_4", "PROD_4", 1, 1.0, "2001-06-30", "ok@mail.org"),
]


@pytest.fixture()
def batch(spark):
    return spark.createDataFrame(ROWS, RETAIL_ORDER_SCHEMA)


def test_rule_semantics(spark, batch):
    rules = retail_suite("2001-06-30")
    ann = V.annotate(batch, rules)
    stats = {r["rule_index"]: r for r in V.rule_stats(ann, rules).collect()}
    assert stats[0]["unexpected_count"] == 1  # order_id null
    assert stats[1]["unexpected_count"] == 2  # both members of the duplicate group
    assert stats[2]["unexpected_count"] == 1
    assert stats[3]["unexpected_count"] == 1
    # price: 0.0 and -3.5 fail; NaN is missing, not a failure
    assert stats[4]["unexpected_count"] == 2
    assert stats[4]["missing_count"] == 1
    assert stats[5]["unexpected_count"] == 1  # quantity 0
    assert stats[6]["unexpected_count"] == 2  # NULL email passes the regex rule
    assert stats[7]["unexpected_count"] == 1  # string comparison with the cut-off
    assert stats[0]["unexpected_percent"] == pytest.approx(20.0)  # base: all rows
    assert stats[6]["unexpected_percent"] == pytest.approx(50.0)  # base: non-null rows
    assert all(not s["success"] for s in stats.values())
    assert stats[0]["element_count"] == 5


def test_reasons_in_suite_order(spark, batch):
    q = V.quarantine_rows(V.annotate(batch, retail_suite("2001-06-30")))
    reasons = {r["customer_id"]: r[V.REASONS] for r in q.collect()}
    assert reasons["CUST_2"] == (
        "order_id failed expect_column_values_to_be_unique (value: ORD_1), "
        "price failed expect_column_values_to_be_between (value: 0.0), "
        "customer_email failed expect_column_values_to_match_regex (value: john.doe@)"
    )
    assert reasons[None].startswith("order_id failed expect_column_values_to_not_be_null (value: None)")


def test_split_is_a_partition_of_the_batch(spark):
    batch = fixtures.retail_orders(spark, SF001)
    ann = V.annotate(batch, retail_suite(fixtures.AS_OF_DATE))
    clean, quarantine = V.clean_rows(ann), V.quarantine_rows(ann).drop(V.REASONS)
    assert clean.count() + quarantine.count() == batch.count()
    assert clean.unionByName(quarantine).exceptAll(batch).count() == 0
    assert batch.exceptAll(clean.unionByName(quarantine)).count() == 0
    stats = V.batch_stats(ann).first()
    assert (stats["total"], stats["clean"], stats["quarantine"]) == (15000, 12216, 2784)
    assert stats["success_rate"] == pytest.approx(81.44)


def test_expected_fixture_counts(spark):
    rules = retail_suite(fixtures.AS_OF_DATE)
    stats = V.rule_stats(V.annotate(fixtures.retail_orders(spark, SF001), rules), rules)
    got = [r["unexpected_count"] for r in stats.orderBy("rule_index").collect()]
    assert got == [155, 586, 366, 246, 525, 406, 534, 209]


def test_unique_with_forced_shuffle_join(spark, batch):
    """Beyond the broadcast bound the duplicate set is joined by shuffle."""
    rules = [unique("order_id")]
    small = V.rule_stats(V.annotate(batch, rules), rules).first()["unexpected_count"]
    big = V.rule_stats(V.annotate(batch, rules, max_broadcast_bytes=0), rules).first()["unexpected_count"]
    assert small == big == 2


def test_two_sided_between_and_regex_dollar(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "q int")
    rules = [between("q", 1, 5)]
    fails = V.rule_failures(V.annotate(df, rules), rules, 0)
    assert sorted(r["q"] for r in fails.collect()) == [0, 6]
    emails = spark.createDataFrame([("a@b.co",), ("a@b.co\n",), ("a@b",)], "e string")
    rules = [match_regex("e", EMAIL_REGEX)]
    ann = V.annotate(emails, rules)
    # Java's $ also matches before a final line break, as Python's does
    assert V.rule_stats(ann, rules).first()["unexpected_count"] == 1


def test_gate_and_gated_load(spark, tmp_dir):
    ann = V.annotate(fixtures.retail_orders(spark, SF001), retail_suite(fixtures.AS_OF_DATE))
    stats = V.batch_stats(ann)
    assert gate(stats, 85.0).first()["decision"] == "STOP"
    assert gate(stats, 80.0).first()["decision"] == "INGEST"
    clean = V.clean_rows(ann)
    assert gated_rows(clean, stats, 85.0).count() == 0
    assert gated_rows(clean, stats, 80.0).count() == 12216
    assert not gated_load(clean, stats, f"{tmp_dir}/orders", 85.0)
    assert gated_load(clean, stats, f"{tmp_dir}/orders", 80.0)
    assert gated_load(clean, stats, f"{tmp_dir}/orders", 80.0)  # a retry replaces
    assert gated_load(clean.limit(10), stats, f"{tmp_dir}/orders", 80.0, batch_id="2")
    assert spark.read.parquet(f"{tmp_dir}/orders").where("batch_id = 1").count() == 12216
    assert spark.read.parquet(f"{tmp_dir}/orders").count() == 12226


def test_empty_batch(spark):
    empty = spark.createDataFrame([], RETAIL_ORDER_SCHEMA)
    s = V.batch_stats(V.annotate(empty, retail_suite(fixtures.AS_OF_DATE))).first()
    assert (s["total"], s["clean"], s["success_rate"]) == (0, 0, 0.0)
    assert gate(V.batch_stats(V.annotate(empty, retail_suite(fixtures.AS_OF_DATE)))).first()["decision"] == "STOP"


def test_empty_batch_is_written_and_stopped(spark, tmp_dir):
    empty = spark.createDataFrame([], RETAIL_ORDER_SCHEMA)
    run = validate_batch(spark, empty, retail_suite(fixtures.AS_OF_DATE), tmp_dir)
    assert run.decision.first()["decision"] == "STOP" and run.clean.count() == 0
    assert run.clean.columns == RETAIL_ORDER_SCHEMA.names


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_unique_on_a_later_column_with_nan(spark, max_bytes):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("b", nan), ("c", nan), ("d", 1.0), ("e", None)], "`odd name` string, `x.y` double")
    ann = V.annotate(df, [unique("x.y"), not_null("x.y")], max_bytes)
    assert V.clean_rows(ann).columns == df.columns and V.clean_rows(ann).count() == 0
    stats = V.rule_stats(ann, [unique("x.y"), not_null("x.y")]).collect()
    assert [(r["unexpected_count"], r["unexpected_percent"]) for r in stats] == [(2, 100.0), (3, 60.0)]
    reasons = {r["odd name"]: r[V.REASONS] for r in V.quarantine_rows(ann).collect()}
    assert reasons["b"] == reasons["e"] == "x.y failed expect_column_values_to_not_be_null (value: None)"


def test_missing_column_names_the_rule(spark):
    with pytest.raises(AnalysisException, match="rule 1 .*'gone'"):
        V.annotate(spark.createDataFrame([(1,)], "x int"), [not_null("x"), unique("gone")])


def test_counting_builds_no_arrays(spark):
    ann = V.annotate(fixtures.retail_orders(spark, SF001), retail_suite(fixtures.AS_OF_DATE))
    for df in (V.batch_stats(ann), V.clean_rows(ann)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "filter(array(" not in plan and "array_compact" not in plan


def test_report_frames(spark, batch):
    rules = retail_suite("2001-06-30")
    ann = V.annotate(batch, rules)
    results = V.rule_stats(ann, rules, with_kwargs=True)
    checks = {r["check_number"]: r for r in report.report_checks(results).collect()}
    assert checks[1]["criteria"] == "Expect order_id to contain no null values."
    assert checks[2]["criteria"] == "Expect order_id to contain only unique values."
    assert checks[5]["criteria"] == "Expect price to be at least 0.01."
    assert checks[7]["criteria"] == "Expect customer_email to match standard format."
    assert checks[8]["criteria"] == "Expect transaction_date to be at most 2001-06-30."
    assert checks[1]["status"] == "Failed"
    two = [between("quantity", 1, 5)]
    c = report.report_checks(V.rule_stats(V.annotate(batch, two), two, with_kwargs=True)).first()
    assert c["criteria"] == "Expect quantity to be between 1 and 5."
    summary = report.report_summary(V.rule_stats(ann, rules), V.batch_stats(ann)).first()
    assert summary["total_checks"] == 8 and summary["failed_checks"] == 8 and summary["row_count"] == 5
    assert summary["gate_status"] == "Pipeline Stopped"


def test_validate_batch_writes_outputs(spark, tmp_dir):
    batch = fixtures.retail_orders(spark, SF001)
    run = validate_batch(spark, batch, retail_suite(fixtures.AS_OF_DATE), tmp_dir, csv_outputs=True)
    assert run.clean.count() == 12216
    assert run.quarantine.count() == 2784
    assert run.decision.first()["decision"] == "STOP"
    res = run.results.orderBy("rule_index").collect()
    assert [r["unexpected_count"] for r in res] == [155, 586, 366, 246, 525, 406, 534, 209]
    assert res[4]["kwargs"] == {"column": "price", "min_value": "0.01"}
    assert not any(r["success"] for r in res)
    assert math.isclose(res[0]["unexpected_percent"], 155 / 15000 * 100)
    assert spark.read.option("header", True).csv(f"{tmp_dir}/quarantine_csv").count() == 2784


def test_not_null_only_suite_passes_clean_batch(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    rules = [not_null("x"), unique("x")]
    ann = V.annotate(df, rules)
    assert all(r["success"] for r in V.rule_stats(ann, rules).collect())
    assert V.quarantine_rows(ann).count() == 0
    assert ann.where(F.size(V.FAILURES) > 0).count() == 0


def test_report_summary_scans_each_input_once(spark, tmp_dir):
    path = f"{tmp_dir}/batch"
    fixtures.retail_orders(spark, SF001).write.parquet(path)
    rules = retail_suite(fixtures.AS_OF_DATE)
    ann = V.annotate(spark.read.parquet(path), rules)
    summary = report.report_summary(V.rule_stats(ann, rules), V.batch_stats(ann))
    row = summary.first()
    assert (row["total_rows"], row["clean_rows"], row["total_checks"], row["passed_checks"]) == (15000, 12216, 8, 0)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan
    assert plan.count("FileScan") == 2  # the rule statistics and the batch statistics


def test_row_level_rule_query_is_one_narrow_scan(spark):
    from quaylake.plans.catalog import all_queries

    q = all_queries()
    price = q["dq_price_min"](spark, SF001)
    assert price.count() == 525
    plan = price._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1
    unique_plan = q["dq_order_id_unique"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in unique_plan  # only the uniqueness rule needs the duplicate-key set
