"""Joins against a side whose size is measured before it is broadcast.

``join_small`` materialises the (already reduced) small side once (reliable
``checkpoint`` into the shared checkpoint folder, so a lost executor does not
lose it), measures its row count and byte size with one aggregate, and only
then adds the broadcast hint. Beyond the bound the join stays a shuffle join,
where AQE's skew-join splitting applies to hot keys and NULL keys (which
cannot match) are spread over the reducers by ``spread_null_keys``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.session import shared_dir

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


@dataclass(frozen=True)
class Measured:
    df: DataFrame
    rows: int
    bytes: int
    small: bool


def _width(field: T.StructField) -> "F.Column":
    dtype = type(field.dataType)
    col = F.col(f"`{field.name}`")
    if dtype in (T.StringType, T.BinaryType):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("long") + F.lit(8)
    if dtype in _FIXED_WIDTH:
        return F.lit(_FIXED_WIDTH[dtype])
    # nested values: bounded through their JSON text
    return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("long")


def _size_columns(df: DataFrame) -> list:
    widths = [_width(f) for f in df.schema.fields] or [F.lit(0)]
    row_bytes = widths[0]
    for w in widths[1:]:
        row_bytes = row_bytes + w
    return [F.count(F.lit(1)).alias("n"), F.sum(row_bytes + F.lit(16)).alias("b")]


def _size(df: DataFrame) -> tuple[int, int]:
    stats = df.agg(*_size_columns(df)).first()
    return int(stats["n"]), int(stats["b"] or 0)


def measure(df: DataFrame, max_bytes: int | None = None, materialize: str = "first") -> Measured:
    """Row count and an upper estimate of the in-memory bytes of ``df``.

    ``materialize='first'``: checkpoint, then measure the stored rows (for a
    side that is already reduced, e.g. an aggregate; it is computed once).
    ``'if_small'``: measure with one aggregate pass and checkpoint only when
    under ``max_bytes`` (for a side that may be large, e.g. a merge source,
    so a big one is never written out). ``'never'``: measure only.
    """
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if materialize == "first":
        shared_dir(df.sparkSession)  # make sure a checkpoint folder exists
        # the size is observed while the checkpoint is written: no extra job
        # (a retried task can only over-count, which keeps the check safe)
        obs = Observation()
        df = df.observe(obs, *_size_columns(df)).checkpoint(eager=True)
        stats = obs.get
        rows, size = int(stats["n"]), int(stats["b"] or 0)
    else:
        rows, size = _size(df)
    small = limit >= 0 and size <= limit
    if materialize == "if_small" and small:
        shared_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return Measured(df, rows, size, small)


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (-1 disables broadcasting)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix) and raw[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(raw[: -len(suffix)]) * units[suffix]
    return int(raw)


def _hashable(field: T.StructField):
    """The column, or its JSON text where it holds a MAP (which has no hash)."""
    col = F.col(f"`{field.name}`")

    def has_map(t: T.DataType) -> bool:
        if isinstance(t, T.MapType):
            return True
        if isinstance(t, T.ArrayType):
            return has_map(t.elementType)
        return isinstance(t, T.StructType) and any(has_map(f.dataType) for f in t.fields)

    return F.to_json(F.struct(col)) if has_map(field.dataType) else col


_SALT = "_null_spread"
_SPREADABLE = {"left", "left_outer", "leftouter", "left_anti", "leftanti", "anti"}


def spread_null_keys(big: DataFrame, small: DataFrame, keys: list[str], how: str):
    """For a shuffle join that keeps unmatched left rows, spread left rows with
    a NULL key over the reducers instead of hashing them all to one task.

    NULL never equals anything, so such rows cannot match; an extra join key
    (a deterministic hash of the row for NULL-key rows, 0 otherwise, and 0 on
    the right) only changes where they land. Deterministic, so a retried map
    task places every row where the first attempt did.
    Returns ``(left, right, join_keys)``.
    """
    if how.lower() not in _SPREADABLE:
        return big, small, keys
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(f"`{k}`").isNull()
    width = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions", "200") or 200)
    salt = F.when(any_null, F.pmod(F.xxhash64(*[_hashable(f) for f in big.schema.fields]), F.lit(width))).otherwise(F.lit(0))
    return big.withColumn(_SALT, salt.cast("long")), small.withColumn(_SALT, F.lit(0).cast("long")), keys + [_SALT]


def join_small(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    max_bytes: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``small``; broadcast ``small`` only if measured under
    ``max_bytes`` (default: the session broadcast threshold). ``on`` is a
    column name, a list of names, or a callable ``(big, small) -> Column``
    evaluated against the materialised small side."""
    limit = broadcast_limit(big) if max_bytes is None else max_bytes
    m = measure(small, limit)
    if m.small:
        cond = on(big, m.df) if callable(on) else on
        return big.join(F.broadcast(m.df), cond, how)
    if callable(on):
        return big.join(m.df, on(big, m.df), how)
    keys = [on] if isinstance(on, str) else list(on)
    left, right, join_keys = spread_null_keys(big, m.df, keys, how)
    return left.join(right, join_keys, how).drop(_SALT)
