"""Row changes on partitioned file tables that rewrite changed partitions only.

Each statement first finds the partitions with rows that it changes, adds or takes
away (a scan of the partition and key columns), reads these alone, and writes
their new content with dynamic partition overwrite. Files of all other
partitions are neither read in full nor touched. A partition that the change
leaves empty is removed.

The new content is stored in the shared folder before the table is written, so the
table is never read while it changes, and a run that is lost half way is done
again from its input: a partition is replaced as a whole. Statements on one table
must not run at the same time. The driver holds the values of changed partitions,
as the file index holds those of all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.operators import dml
from quaylake.operators.evolve import Layout, read_layouts, write_layout
from quaylake.plans.broadcast import join_small
from quaylake.session import scratch_path

_FLAG = "_changed"


def _same(row: Row, by: Sequence[str]) -> Column:
    """Whether a row is of the partition with the values of ``row``."""
    tests = [F.col(f"`{c}`").isNull() if row[c] is None else F.col(f"`{c}`") == F.lit(row[c]) for c in by]
    return reduce(lambda a, b: a & b, tests)


def _any_of(rows: Sequence[Row], by: Sequence[str]) -> Column:
    if len(by) == 1:
        c = F.col(f"`{by[0]}`")
        known = [r[0] for r in rows if r[0] is not None]
        return c.isin(known) | c.isNull() if len(known) < len(rows) else c.isin(known)
    return reduce(lambda a, b: a | b, [_same(r, by) for r in rows])


def _rewrite(
    spark: SparkSession,
    table: Layout,
    schema: T.StructType,
    changed: DataFrame,
    change: Callable[[DataFrame], DataFrame],
) -> list[Row]:
    """Apply ``change`` to the partitions listed in ``changed``; returns them."""
    by = list(table.partition_by)
    rows = changed.select(*[F.col(f"`{c}`") for c in by]).distinct().collect()
    if not rows:
        return []
    current = read_layouts(spark, [table], schema).where(_any_of(rows, by))
    path = scratch_path(spark, "rewritten")
    change(current).write.parquet(path)
    new = spark.read.schema(schema).parquet(path)
    write_layout(new, table, mode="overwrite", dynamic=True)
    left = {tuple(r) for r in new.select(*[F.col(f"`{c}`") for c in by]).distinct().collect()}
    _drop_partitions(spark, table, [r for r in rows if tuple(r) not in left], schema)
    return rows


def _drop_partitions(spark: SparkSession, table: Layout, rows: Sequence[Row], schema: T.StructType) -> None:
    """Remove the folders of partitions; they are found by the files in them."""
    if not rows:
        return
    held = read_layouts(spark, [table], schema, file_column="_file").where(_any_of(rows, table.partition_by))
    folders = held.select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct().collect()
    sc = spark.sparkContext
    for r in folders:
        path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(r["folder"]))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def update_partitions(
    spark: SparkSession, table: Layout, schema: T.StructType, predicate, assignments: Mapping[str, object]
) -> list[Row]:
    """UPDATE ... SET ... WHERE; returns the rewritten partitions. A row whose partition
    field is set moves."""
    hit = read_layouts(spark, [table], schema).where(dml._pred(predicate))
    moved = dml.update_where(hit, F.lit(True), assignments)
    changed = hit.select(*table.partition_by).unionByName(moved.select(*table.partition_by))
    return _rewrite(spark, table, schema, changed, lambda current: dml.update_where(current, predicate, assignments))


def delete_partitions(spark: SparkSession, table: Layout, schema: T.StructType, predicate) -> list[Row]:
    """DELETE WHERE; returns the rewritten partitions."""
    hit = read_layouts(spark, [table], schema).where(dml._pred(predicate))
    return _rewrite(spark, table, schema, hit, lambda current: dml.delete_where(current, predicate))


def merge_partitions(
    spark: SparkSession,
    table: Layout,
    schema: T.StructType,
    source: DataFrame,
    on: str | Sequence[str],
    update: Mapping[str, object] | None = None,
    insert: bool = True,
) -> list[Row]:
    """MERGE (see ``dml.merge_into``); returns the rewritten partitions: those of matched
    rows before and after the update, and those of inserted rows."""
    keys = [on] if isinstance(on, str) else list(on)
    by = list(table.partition_by)
    path = scratch_path(spark, "merge_source")
    source.write.parquet(path)  # read by all steps, so it must not change between them
    source = spark.read.schema(source.schema).parquet(path)
    whole = read_layouts(spark, [table], schema)
    changed = spark.createDataFrame([], T.StructType([schema[c] for c in by]))
    if update:
        narrow = whole.select(*dict.fromkeys([*keys, *by]))
        matched = join_small(narrow, dml._by_table_name(source, narrow).select(*keys).distinct(), keys, "left_semi")
        changed = changed.unionByName(matched.select(*by))
        moves = {c: v for c, v in update.items() if c.lower() in {b.lower() for b in by}}
        if moves:
            changed = changed.unionByName(dml.merge_into(matched, source, on, moves, insert=False).select(*by))
    fresh = None
    if insert:
        # what matches nothing in the whole table, not only in the partitions read again
        merged = dml.merge_into(whole, source, on, None, matched_flag=_FLAG)
        path = scratch_path(spark, "merge_inserts")
        merged.where(F.col(_FLAG).isNull()).drop(_FLAG).write.parquet(path)
        fresh = spark.read.schema(schema).parquet(path)
        changed = changed.unionByName(fresh.select(*by))

    def change(current: DataFrame) -> DataFrame:
        # all matched rows are in the partitions that are read
        out = dml.merge_into(current, source, on, update, insert=False) if update else current
        return out if fresh is None else out.unionByName(fresh)

    return _rewrite(spark, table, schema, changed, change)
