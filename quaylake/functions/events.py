"""JSON event codec shared by the batch and the streaming path.

``decode_events`` is the same plan for a static and for a streaming frame:
cast the payload bytes to text, parse with the declared schema, expand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
MALFORMED_MODES = ("keep", "drop", "quarantine")


def encode_event(*cols: str | Column) -> Column:
    """One JSON object per row; NULL fields are written as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def encode_events(df: DataFrame, key: str | None = None) -> DataFrame:
    """``value`` (and optionally ``key``) columns, ready for a Kafka or text sink."""
    out = [encode_event(*[F.col(f"`{c}`") for c in df.columns]).alias("value")]
    if key is not None:
        out.insert(0, F.col(f"`{key}`").cast("string").alias("key"))
    return df.select(*out)


def payload_text(value: Column) -> Column:
    return value.cast("string")


def decode_events(df: DataFrame, schema: T.StructType, on_malformed: str = "keep", value_col: str = "value") -> DataFrame:
    """Typed rows from JSON payloads.

    ``keep``: a malformed payload becomes an all-NULL row and a value of the
    wrong type (``"12"`` for a double) a NULL field (plain ``from_json``).
    ``drop``: malformed, empty and wrongly typed records are removed.
    ``quarantine``: every row is kept; bad ones carry their text in
    ``_corrupt_record``.
    """
    if on_malformed not in MALFORMED_MODES:
        raise ValueError(f"on_malformed must be one of {MALFORMED_MODES}")
    text = payload_text(F.col(value_col))
    if on_malformed == "keep":
        return df.select(F.from_json(text, schema).alias("data")).select("data.*")
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = df.select(
        text.alias("_payload"),
        F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT}).alias("data"),
    )
    bad = (
        F.col("data").isNull()
        | (F.trim(F.coalesce(F.col("_payload"), F.lit(""))) == "")
        | F.col(f"data.{CORRUPT}").isNotNull()
    )
    if on_malformed == "drop":
        return parsed.where(~bad).select(*[F.col(f"data.`{f.name}`").alias(f.name) for f in schema.fields])
    return parsed.select(
        *[F.col(f"data.`{f.name}`").alias(f.name) for f in schema.fields],
        F.when(bad, F.coalesce(F.col(f"data.{CORRUPT}"), F.col("_payload"), F.lit(""))).alias(CORRUPT),
    )


def json_field(text: Column, field: str, dtype: str) -> Column:
    """One typed field of a JSON object column (NULL when absent or mistyped)."""
    return F.from_json(text, f"`{field}` {dtype}")[field]
