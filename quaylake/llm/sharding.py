"""Reproducible shuffle into shards: a Feistel permutation over row numbers.

Every row gets a global row number, the number goes through a keyed
permutation of ``0 .. n-1`` and the permuted position fixes shard and slot:
``shard = position mod k``, ``slot = position div k``. Shard sizes differ by
one row at most (law ``rows``), slots are gapless, and both can be computed
from the row number, ``n`` and the seed alone.

The permutation is a Feistel network on the grid ``a x b`` with
``a = ceil(sqrt n)`` and ``b = ceil(n / a)``, so fewer than ``a`` grid points lie
outside the domain; a point that lands there walks on (cycle walking) until
it is inside again. The walk may be as long as there are outside points, so
it always ends and needs no cap.

Row numbers come without a global sort. Rows are grouped by their key columns
(equal rows are interchangeable and travel as one row with a count), the
groups are dealt to a fixed number of hash buckets and numbered inside their
bucket; bucket offsets are a running total over that fixed number of rows.

Defined cases: NULL keys are ordinary values; repeated rows get a number each;
an empty table gives no rows; columns other than the keys are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import only

#: buckets of the numbering; also the bound of the broadcast offset table
NUMBER_BUCKETS = 8192
ROUNDS = 4


def _feistel(x: Column, a: Column, b: Column, seed: int) -> Column:
    """One pass of the alternating Feistel network on ``0 .. a*b-1``."""
    right = x % b
    left = ((x - right) / b).cast("long")
    for r in range(ROUNDS):
        if r % 2 == 0:
            left = (left + F.pmod(F.xxhash64(right, F.lit(seed + r).cast("long")), a)) % a
        else:
            right = (right + F.pmod(F.xxhash64(left, F.lit(seed + r).cast("long")), b)) % b
    return left * b + right


def permute(x: Column, n: Column, a: Column, b: Column, seed: int) -> Column:
    """Permutation of ``0 .. n-1`` by ``_feistel`` and cycle walking."""
    once = _feistel(x, a, b, seed)
    outside = (a * b - n).cast("int")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.greatest(outside, F.lit(1))),
        once,
        lambda p, _: F.when(p < n, p).otherwise(_feistel(p, a, b, seed)),
    )
    return F.when(once < n, once).otherwise(walked)


def number_rows(df: DataFrame, keys: list[str], seed: int = 0, buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """One row per distinct key combination (columns ``key0``, ``key1`` ...) with ``_n``
    copies, ``_first`` (row number of the first copy) and ``_total`` (rows of the
    table)."""
    inner = [f"key{i}" for i in range(len(keys))]
    cols = [F.col(k) for k in inner]
    groups = (
        only(df, **dict(zip(inner, keys, strict=True)))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.pmod(F.xxhash64(*cols, F.lit(seed).cast("long")), F.lit(buckets)))
    )
    per_bucket = groups.groupBy("_bucket").agg(F.sum("_n").alias("_rows"))
    # at most `buckets` rows from here on, whatever the size of the table
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_bucket.select(
        "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(whole).alias("_total"),
    )
    inside = Window.partitionBy("_bucket").orderBy(*[c.asc_nulls_first() for c in cols])
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        groups.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_bucket")
        .select(*cols, "_n", (F.col("_offset") + F.col("_inside")).alias("_first"), "_total")
    )


def shard_rows(
    df: DataFrame, keys: list[str], n_shards: int, seed: int = 0, buckets: int = NUMBER_BUCKETS
) -> DataFrame:
    """One row per input row: the keys, ``row_number``, ``position`` (the shuffled
    place), ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard)."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    side = F.ceil(F.sqrt(F.col("_total").cast("double"))).cast("long")
    numbered = number_rows(df, keys, seed, buckets).withColumn("_a", side)
    numbered = numbered.withColumn("_b", F.ceil(F.col("_total") / F.col("_a")).cast("long"))
    one_each = numbered.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    one_each = one_each.withColumn("row_number", F.col("_first") + F.col("_copy"))
    position = permute(F.col("row_number"), F.col("_total"), F.col("_a"), F.col("_b"), seed)
    return one_each.withColumn("position", position).select(
        *[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)],
        "row_number",
        "position",
        (F.col("position") % n_shards).cast("int").alias("shard"),
        F.floor(F.col("position") / F.lit(n_shards)).cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, keys: list[str], n_shards: int, path: str, seed: int = 0) -> None:
    """Write whole rows as one folder per shard, rows carrying their ``slot``.
    ``keys`` must identify a row up to repeats, which are written each."""
    placed = shard_rows(df, keys, n_shards, seed).alias("r")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    whole = df.dropDuplicates(keys).alias("l").join(placed, cond).select("l.*", "r.shard", "r.slot")
    whole.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
