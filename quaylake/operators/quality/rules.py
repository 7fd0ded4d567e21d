"""Declarative data-quality rules compiled into Spark ``Column`` predicates.

A rule *fails a row*; a rule succeeds when no row fails it. NULL passes every
rule except not-null. Uniqueness needs the whole batch and is resolved by
``validate.annotate`` with one key aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Expectation type names as they appear in results and in
# quarantine reasons, and the e-mail pattern of the retail suite.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
MATCH_REGEX = "expect_column_values_to_match_regex"
EMAIL_REGEX = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


@dataclass(frozen=True)
class Rule:
    expectation: str
    column: str
    min_value: Any = None
    max_value: Any = None
    regex: str | None = None

    def kwargs(self) -> dict[str, str]:
        out = {"column": self.column}
        for name in ("min_value", "max_value", "regex"):
            value = getattr(self, name)
            if value is not None:
                out[name] = str(value)
        return out

    @property
    def counts_nulls(self) -> bool:
        """Percent base: all rows for not-null, non-null rows otherwise."""
        return self.expectation == NOT_NULL

    def fail(self, value: Column, duplicate_flag: Column | None = None) -> Column:
        """Boolean column, true when this rule fails the row (never NULL)."""
        if self.expectation == NOT_NULL:
            return value.isNull()
        if self.expectation == UNIQUE:
            if duplicate_flag is None:
                raise ValueError("uniqueness needs the duplicate-key flag")
            return F.coalesce(duplicate_flag, F.lit(False))
        if self.expectation == BETWEEN:
            cond = F.lit(False)
            if self.min_value is not None:
                cond = cond | (value < F.lit(self.min_value))
            if self.max_value is not None:
                cond = cond | (value > F.lit(self.max_value))
            return F.coalesce(cond, F.lit(False))
        if self.expectation == MATCH_REGEX:
            return F.coalesce(~value.rlike(self.regex), F.lit(False))
        raise ValueError(f"unknown expectation {self.expectation!r}")


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def unique(column: str) -> Rule:
    return Rule(UNIQUE, column)


def between(column: str, min_value: Any = None, max_value: Any = None) -> Rule:
    if min_value is None and max_value is None:
        raise ValueError("between needs min_value or max_value")
    return Rule(BETWEEN, column, min_value=min_value, max_value=max_value)


def match_regex(column: str, regex: str) -> Rule:
    return Rule(MATCH_REGEX, column, regex=regex)


def retail_suite(as_of_date: str) -> list[Rule]:
    """The eight-rule retail order suite, in suite order. ``as_of_date`` is
    the ``yyyy-MM-dd`` cut-off (a parameter, never the wall clock)."""
    return [
        not_null("order_id"),
        unique("order_id"),
        not_null("product_id"),
        not_null("customer_id"),
        between("price", min_value=0.01),
        between("quantity", min_value=1),
        match_regex("customer_email", EMAIL_REGEX),
        between("transaction_date", max_value=as_of_date),
    ]
