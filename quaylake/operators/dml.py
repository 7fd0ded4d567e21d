"""Row-level DML as ``DataFrame -> DataFrame`` operators.

Plain Spark file tables refuse UPDATE / DELETE / MERGE, so each statement is
expressed as the table state it produces. ``update_where`` and
``delete_where`` are narrow (no shuffle). ``merge_into`` avoids a full outer
join: matched target rows come from a left join against the per-key source
(broadcast when measured small), inserts from a left anti join against the
target's distinct keys. Both shapes allow AQE to split a skewed key on the
big side, and a hot target key is collapsed by partial aggregation before it
is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.plans.broadcast import broadcast_limit, measure, spread_null_keys

_SRC = "_merge_src_"
_N = "_merge_src_n"


def _as_column(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.expr(value)
    return F.lit(value)


def _pred(predicate) -> Column:
    """A predicate that treats NULL as false (SQL WHERE semantics)."""
    return F.coalesce(_as_column(predicate), F.lit(False))


def _by_table_name(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with columns that the table has under other letters renamed to the
    table's spelling. Two columns for one name are refused."""
    spelled = {c.lower(): c for c in table.columns}
    names = [spelled.get(c.lower(), c) for c in rows.columns]
    twice = sorted({n for n in names if names.count(n) > 1 and n in spelled.values()})
    if twice:
        raise ValueError(f"columns given more than once: {twice}")
    return rows.toDF(*names)


def insert_append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO: bag union by column name, whatever its letter case. Values are
    cast to the table's types (a value that does not fit fails the job), columns
    the rows lack are NULL, and a column the table lacks is an error."""
    rows = _by_table_name(rows, table)
    unknown = [c for c in rows.columns if c not in table.columns]
    if unknown:
        raise ValueError(f"columns that the table lacks: {unknown}")
    return table.unionByName(_as_table(rows, table))


def _as_table(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The table's columns of ``rows`` in its order and types."""
    return rows.select(
        *[
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )


def update_where(df: DataFrame, predicate, assignments: Mapping[str, object]) -> DataFrame:
    """UPDATE ... SET col = expr WHERE predicate. Rows where the predicate is
    false or NULL are unchanged; all SET expressions see the old row."""
    hit = _pred(predicate)
    changed = {
        name: F.when(hit, _as_column(value).cast(df.schema[name].dataType)).otherwise(F.col(f"`{name}`"))
        for name, value in assignments.items()
    }
    return df.withColumns(changed)


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """DELETE WHERE predicate; rows with a NULL predicate stay."""
    return df.where(~_pred(predicate))


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    update: Mapping[str, object] | None = None,
    insert: bool = True,
    max_broadcast_bytes: int | None = None,
    matched_flag: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """MERGE INTO target USING source ON key equality.

    ``update``: target column -> source column name or Column over source
    columns, applied WHEN MATCHED (None: no matched clause); a column that the
    target lacks is an error.
    ``insert``: WHEN NOT MATCHED insert the source row. Columns are found by
    name, whatever its letter case, and cast to the target's types; further
    source columns serve the update only.
    NULL keys never match, so such source rows insert. More than one source
    row matching a target row raises at execution time; duplicate source
    rows that match nothing all insert.
    ``matched_flag``: name of an extra boolean column, true for target rows
    that met a source row, false for other target rows, NULL for inserts.
    ``buckets``: number of buckets of a target table that is bucketed by the
    keys. The source is dealt to them, and the target is never moved.
    """
    source = _by_table_name(source, target)
    keys = [on] if isinstance(on, str) else list(on)
    spelled = {c.lower(): c for c in target.columns}
    missing = [k for k in keys if k.lower() not in spelled]
    missing += [c for c in update or () if c.lower() not in spelled]
    if missing:
        raise ValueError(f"columns that the target lacks: {missing}")
    keys = [spelled[k.lower()] for k in keys]
    update = {spelled[c.lower()]: v for c, v in (update or {}).items()}
    limit = broadcast_limit(target) if max_broadcast_bytes is None else max_broadcast_bytes
    key_cols = [F.col(f"`{k}`") for k in keys]
    has_keys = F.lit(True)
    for k in key_cols:
        has_keys = has_keys & k.isNotNull()

    # the source is evaluated once: stored while its size is observed, and read
    # by both branches from there, so they see the same rows whatever it computes
    src = measure(source, limit, materialize="first")
    small = src.small and not buckets

    def to_buckets(df: DataFrame) -> DataFrame:
        return df.repartition(buckets, *key_cols) if buckets else df

    out = target.withColumn(matched_flag, F.lit(False)) if matched_flag else target
    if update:
        per_key = (
            to_buckets(src.df.where(has_keys))
            .groupBy(*key_cols)
            .agg(
                F.count(F.lit(1)).alias(_N),
                *[F.first(_as_column(v)).alias(f"{_SRC}{name}") for name, v in update.items()],
            )
        )
        if small:
            joined = target.join(F.broadcast(per_key), keys, "left")
        elif buckets:
            joined = target.join(per_key.hint("merge"), keys, "left")
        else:
            left, right, join_keys = spread_null_keys(target, per_key, keys, "left")
            joined = left.join(right, join_keys, "left").drop(*[k for k in join_keys if k not in keys])
        # the cardinality check sits in a filter so column pruning cannot drop it
        checked = joined.where(
            F.when(
                F.col(_N) > 1,
                F.raise_error(F.lit("MERGE: more than one source row matched a target row")).cast("boolean"),
            ).otherwise(F.lit(True))
        )
        matched = F.col(_N).isNotNull()
        out = checked.select(
            *[
                F.when(matched, F.col(f"{_SRC}{c}").cast(target.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c)
                if c in update
                else F.col(f"`{c}`")
                for c in target.columns
            ],
            *([matched.alias(matched_flag)] if matched_flag else []),
        )
    if not insert:
        return out

    src_rows = _as_table(src.df, target)
    if small:
        src_keys = src_rows.where(has_keys).select(*key_cols).distinct()
        matched_keys = target.select(*key_cols).join(F.broadcast(src_keys), keys, "left_semi").distinct()
        inserts = src_rows.join(F.broadcast(matched_keys), keys, "left_anti")
    elif buckets:
        # the keys of the target stay in their buckets; NULL keys match nothing
        keyed = to_buckets(src_rows.where(has_keys))
        inserts = keyed.join(target.select(*key_cols).hint("merge"), keys, "left_anti")
        inserts = inserts.select(*target.columns).unionByName(src_rows.where(~has_keys))
    else:
        # distinct first: partial aggregation collapses a hot target key map-side
        target_keys = target.select(*key_cols).where(has_keys).distinct()
        left, right, join_keys = spread_null_keys(src_rows, target_keys, keys, "left_anti")
        inserts = left.join(right, join_keys, "left_anti")
    inserts = inserts.select(*target.columns)
    if matched_flag:
        inserts = inserts.withColumn(matched_flag, F.lit(None).cast("boolean"))
    return out.unionByName(inserts)
