"""Schema and partition evolution on file tables.

* Add a column: old files lack it and read NULL. Reads use the declared
  (evolved) schema, never one inferred from an arbitrary file.
* Add a partition field: new writes go to a second root laid out by the new
  field; old data stays where it is. Reading unions the roots by name with
  the declared schema, so partition values keep their declared type and a
  filter on the new field prunes partitions of the new root.
* Read by a dimension: a join on the new field prunes partitions of the new root
  while the query runs (dynamic pruning). The old root has no such partitions;
  there the values of a small dimension are pushed into the scan, which skips
  row groups by their statistics if the root is clustered by the field.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def evolved_schema(schema: T.StructType, *new_fields: T.StructField) -> T.StructType:
    return T.StructType(list(schema.fields) + list(new_fields))


def read_declared(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Files written before a column was added read NULL in it."""
    return spark.read.schema(schema).format(fmt).load(path)


@dataclass
class Layout:
    """One root folder of a table and the fields it is partitioned by."""

    path: str
    partition_by: Sequence[str] = field(default_factory=tuple)


#: stands in a partition path for the empty text, which has no path of its own
_EMPTY = "\u0001"


def write_layout(
    df: DataFrame, layout: Layout, mode: str = "append", dynamic: bool = False, cluster_by: Sequence[str] = ()
) -> None:
    """Write under one root. A partitioned root gets its rows dealt by partition
    value first (Spark splits large values and joins small ones), so there are
    about as many files as values, not as tasks times values. ``dynamic``:
    overwrite the partitions that ``df`` has rows of, and no others. ``cluster_by``:
    sort an unpartitioned root by range, so that row groups hold few values."""
    if not layout.partition_by:
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        df.write.mode(mode).parquet(layout.path)
        return
    for c in layout.partition_by:
        if isinstance(df.schema[c].dataType, T.StringType):
            df = df.withColumn(c, F.when(F.col(f"`{c}`") == "", _EMPTY).otherwise(F.col(f"`{c}`")))
    dealt = df.hint("rebalance", *layout.partition_by)
    writer = dealt.write.mode(mode).partitionBy(*layout.partition_by)
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(layout.path)


def _read_layout(spark: SparkSession, layout: Layout, schema: T.StructType, file_column: str | None = None) -> DataFrame:
    columns = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`").cast(f.dataType)
        if f.name in layout.partition_by and isinstance(f.dataType, T.StringType):
            c = F.when(c == _EMPTY, "").otherwise(c)
        columns.append(c.alias(f.name))
    if file_column:
        columns.append(F.col("_metadata.file_path").alias(file_column))
    return spark.read.schema(schema).parquet(layout.path).select(*columns)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def read_layouts(
    spark: SparkSession, layouts: Sequence[Layout], schema: T.StructType, file_column: str | None = None
) -> DataFrame:
    """Union of all roots by column name under the declared schema; ``file_column``
    adds the file that a row is from."""
    return _union([_read_layout(spark, layout, schema, file_column) for layout in layouts])


#: values of a dimension that are pushed into the scan of an old root, at most
PUSHED_VALUES = 1000


def read_layouts_of(spark: SparkSession, layouts: Sequence[Layout], schema: T.StructType, field: str, dimension: DataFrame) -> DataFrame:
    """Rows of all roots joined with ``dimension`` on ``field`` (a key of it). Roots
    partitioned by the field are pruned by Spark's dynamic pruning; the others by
    the dimension's values, where it has ``PUSHED_VALUES`` at most."""
    values = None
    if any(field not in layout.partition_by for layout in layouts):
        some = dimension.select(field).distinct().limit(PUSHED_VALUES + 1).collect()
        values = [r[0] for r in some] if len(some) <= PUSHED_VALUES else None
    frames = []
    for layout in layouts:
        if field in layout.partition_by:
            # joined on the partition column itself, which pruning asks for
            raw = spark.read.schema(schema).parquet(layout.path)
            key = F.col(f"`{field}`")
            if isinstance(schema[field].dataType, T.StringType):
                stored = dimension.withColumn(field, F.when(key == "", _EMPTY).otherwise(key))
                joined = raw.join(stored, field).withColumn(field, F.when(key == _EMPTY, "").otherwise(key))
            else:
                joined = raw.join(dimension, field)
        else:
            rows = _read_layout(spark, layout, schema)
            if values is not None:
                rows = rows.where(F.col(f"`{field}`").isin(values))
            joined = rows.join(dimension, field)
        extra = [c for c in dimension.columns if c != field]
        frames.append(joined.select(*[F.col(f"`{c}`") for c in [*schema.names, *extra]]))
    return _union(frames)


def add_columns_sql(spark: SparkSession, table: str, *new_fields: T.StructField) -> None:
    """ALTER TABLE ADD COLUMNS on a catalog table (metadata only)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new_fields)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
