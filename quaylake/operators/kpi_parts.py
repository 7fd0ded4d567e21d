"""KPIs of parts that merge without reading their rows again.

A part (a day, say) is reduced once to sums and, for the exact distinct count, to
bitmaps over numbered values: one bitmap of 32768 bits for each bucket of numbers
that occurs. Parts merge by adding the sums and joining the bitmaps with OR, over
any set of parts, so a dashboard reads a few rows a part and never the table.

The numbers come from a dictionary of the values seen so far. It only ever grows:
values of a later load that it lacks get the numbers behind the last one, dealt
by hash buckets, so no task numbers all of them. Bitmaps of earlier parts stay
valid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.operators.kpis import _numeric
from quaylake.plans.broadcast import join_small

#: hash buckets in which new values are numbered
NUMBER_BUCKETS = 1024
PART = "part"


def number_values(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``value`` and ``number`` (from 1, without gaps) of all values of ``column`` that
    ``known`` lacks, behind its numbers; NULL has no number."""
    new = values.select(F.col(f"`{column}`").alias("value")).where("value IS NOT NULL").distinct()
    last = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
        last = F.lit(known.agg(F.max("number")).first()[0] or 0).cast("long")
    new = new.withColumn("_bucket", F.pmod(F.xxhash64("value"), F.lit(NUMBER_BUCKETS)))
    # a row for each bucket, whatever the number of values
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = new.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("value"))
    numbered = new.withColumn("_inside", inside).join(F.broadcast(offsets), "_bucket")
    return numbered.select("value", (last + F.col("_before") + F.col("_inside")).alias("number"))


def kpi_parts(df: DataFrame, part: Column, numbers: DataFrame, distinct: str = "vehicle_id") -> DataFrame:
    """One row per part and bucket of numbers: ``rows``, sums of revenue and weight,
    ``weights`` (values summed) and ``seen``, the bitmap of the numbers. A value
    that ``numbers`` lacks fails the job."""
    value = F.col(f"`{distinct}`")
    columns = df.select(part.alias(PART), value.alias("value"), _numeric(df, "revenue").alias("revenue"), _numeric(df, "weight").alias("weight"))
    numbered = join_small(columns, numbers, "value", "left")
    lost = F.col("value").isNotNull() & F.col("number").isNull()
    number = F.when(lost, F.raise_error(F.concat(F.lit("no number for "), F.col("value").cast("string"))).cast("long")).otherwise(F.col("number"))
    numbered = numbered.withColumn("number", number).withColumn("bucket", F.bitmap_bucket_number("number"))
    return numbered.groupBy(PART, "bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("revenue").alias("revenue"),
        F.sum("weight").alias("weight"),
        F.count("weight").alias("weights"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("seen"),
    )


def merge_parts(parts: DataFrame, by: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """The KPIs of ``kpi_summary`` over all parts, or per group ``by`` (name, column
    over ``part``)."""
    names = [name for name, _ in by]
    sums = [F.sum(c).alias(c) for c in ("rows", "revenue", "weight", "weights")]
    grouped = parts.withColumns(dict(by)) if by else parts
    buckets = grouped.groupBy(*names, "bucket").agg(*sums, F.bitmap_or_agg("seen").alias("seen"))
    known = F.when(F.col("bucket").isNotNull(), F.bitmap_count("seen")).otherwise(F.lit(0))
    one = buckets.groupBy(*names).agg(*sums, F.sum(known).alias("distinct"))
    zero = lambda c, kind: F.coalesce(F.col(c), F.lit(0)).cast(kind)
    return one.select(
        *names,
        zero("rows", "long").alias("total_shipments"),
        zero("revenue", "double").alias("total_revenue"),
        F.when(F.col("weights") > 0, F.col("weight") / F.col("weights")).alias("avg_weight"),
        zero("distinct", "long").alias("unique_vehicles"),
    )
