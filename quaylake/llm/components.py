"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every vertex tells its larger
neighbours (then its smaller ones) the least vertex it knows, until nothing
changes. Each step is one grouped minimum (with map-side partial aggregation,
so a hub is one row per task) and one join that adaptive execution can split.
Tables between steps are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v; returns edges of the same form."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    told = around.join(least, "u")
    told = told.filter("v > u") if large else told
    out = told.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Number and order-free hash of the edges."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
    return tuple(row)


def components(edges: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """``vertex`` and ``component`` (its least vertex) of all vertices with an edge
    to another one. Vertices are longs; loops and repeated edges are allowed.
    ``rows``: an upper bound of the edges, if known."""
    pair = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pair = stored(pair, "edges", rows)
    before = None
    now = _digest(pair)
    while now != before and now[0]:
        before = now
        pair = stored(_star(_star(pair, large=True), large=False), "edges", 2 * now[0])
        now = _digest(pair)
    found = pair.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return found.unionByName(pair.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
