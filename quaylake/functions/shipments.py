"""Shipment column rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Revenue per weight unit by priority.
HIGH_PRIORITY = "High"
HIGH_RATE = 15.0
BASE_RATE = 10.0


def priority_rate(priority: Column) -> Column:
    return F.when(priority == F.lit(HIGH_PRIORITY), F.lit(HIGH_RATE)).otherwise(F.lit(BASE_RATE))


def derive_revenue(weight: Column, priority: Column) -> Column:
    """``round(weight * rate, 2)``; Spark's round is half-up on the decimal
    text of the value."""
    return F.round(weight * priority_rate(priority), 2)
