"""CSV source with missing-value tokens and declared or inferred types, and CSV sink.

Reading loses nothing. Columns are found by the names in each file's header,
so their order does not matter; a header that lacks a declared column or has an
unknown one is an error. A value that does not fit its type, and a record with
the wrong number of fields, keep their text in ``_corrupt_record`` next to what
could be read: ``split_csv`` gives the good rows and the bad ones.

The text is scanned once. With ``headers="by_file"`` (the default) that scan
stores all records as they stand, with their file and place; the first record of
each file is its header, found by an aggregate over the places, and records meet
the column order of their file in a join of checked size. Neither files nor
headers reach the driver. With ``headers="same"`` one header is looked at, nothing
is stored, and the scan itself fails on a file that has another one.

Types are inferred from all rows in one aggregate, without sampling: a column is
boolean, bigint, double or date if all its values are, else text.

Fields are quoted by RFC 4180 (quotes are doubled). The sink quotes every
non-NULL text and writes NULL as nothing at all, so blanks, quotes, empty texts
and line breaks come back as they were. Values with line breaks need
``multi_line=True``, which costs the splitting of files: a file is then one
task.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.plans.broadcast import join_small
from quaylake.session import scratch_path

CORRUPT = "_corrupt_record"
_RAW = "_raw_record"
_HEAD = "_is_header"

# Texts of an unquoted or quoted field that are read as missing,
# compared as they stand (no trimming).
DEFAULT_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
#: a column has the first of these types that all its values have, else string
_LATTICE = {"boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}


def _names(head: str) -> list[str]:
    return next(csv.reader([head.removeprefix("\ufeff")]), [])


def _empty_marker() -> str:
    """Stands for an empty text that was quoted, so that it differs from no text; new
    for each read, so that no value can be taken for it."""
    return f"\u0000{uuid.uuid4().hex}"


def _text_reader(spark: SparkSession, names: Sequence[str], empty: str, multi_line: bool):
    """Reader of all fields as text; ``_raw_record`` has a record with other than
    ``names`` fields."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
    # a quoted empty field is an empty text, a field of nothing is NULL
    reader = reader.option("emptyValue", empty).option("nullValue", "")
    return reader.option("escape", '"').option("multiLine", multi_line)


def _some_header(spark: SparkSession, path: str) -> list[str] | None:
    """The first line of a file under ``path``: a task stops after one row."""
    first = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).select("value").head()
    return None if first is None else _names(first["value"])


def _check_names(found: Sequence[str], names: Sequence[str]) -> None:
    if sorted(found) != sorted(names):
        raise ValueError(f"CSV header {list(found)} does not match the columns {list(names)}")


def _by_file(spark: SparkSession, path: str, names: list[str], empty: str, multi_line: bool) -> DataFrame:
    """Records with the fields of ``names``, whatever their order in each file."""
    fields = [f"f{i}" for i in range(len(names))]
    scan = _text_reader(spark, fields, empty, multi_line).option("header", False).csv(path)
    meta = F.col("_metadata")
    records = scan.select(
        meta["file_path"].alias("file"), (meta["file_block_start"] == 0).alias("in_first_block"), *fields, _RAW
    ).withColumn("at", F.monotonically_increasing_id())
    stored = scratch_path(spark, "csv_records")
    records.write.parquet(stored)
    records = spark.read.schema(records.schema).parquet(stored)

    first = records.where("in_first_block").groupBy("file").agg(F.min("at").alias("at"))
    shown = [F.when(F.col(f) == empty, "").otherwise(F.coalesce(F.col(f), F.lit(""))) for f in fields]
    heads = join_small(records.select("at", *fields, _RAW), first, "at").select("file", "at", F.array(*shown).alias("found"), _RAW)
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    wrong = F.col(_RAW).isNotNull() | (F.array_sort("found") != F.array_sort(wanted))
    bad = heads.where(wrong).select("found", _RAW).head()
    if bad is not None:
        _check_names(bad["found"] if bad[_RAW] is None else _names(bad[_RAW]), names)
    order = F.transform(wanted, lambda n: F.array_position("found", n).cast("int"))
    rows = join_small(records, heads.select("file", F.col("at").alias("head_at"), order.alias("order")), "file")
    values = F.array(*fields)
    fields = [F.element_at(values, F.col("order")[i]).alias(n) for i, n in enumerate(names)]
    return rows.select(*fields, _RAW, (F.col("at") == F.col("head_at")).alias(_HEAD))


def _text_records(
    spark: SparkSession, path: str, names: list[str] | None, header: bool, multi_line: bool, headers: str
) -> tuple[DataFrame, list[str], str]:
    """All records as text columns, ``_raw_record`` and ``_is_header``; their names; the
    mark of an empty text. ``names`` None: those of a header."""
    if headers not in ("by_file", "same"):
        raise ValueError(f"headers must be 'by_file' or 'same', not {headers!r}")
    if not header and names is None:
        raise ValueError("a file without a header needs column names")
    empty = _empty_marker()
    if not header:
        raw = _text_reader(spark, names, empty, multi_line).option("header", False).csv(path)
        return raw.withColumn(_HEAD, F.lit(False)), names, empty
    found = _some_header(spark, path)
    if found is None:
        names = names or []
        nothing = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
        return spark.createDataFrame([], nothing.add(_HEAD, T.BooleanType())), names, empty
    if names is not None:
        _check_names(found, names)
    if headers == "by_file":
        return _by_file(spark, path, names or found, empty, multi_line), names or found, empty
    # the scan compares the header of every file with the schema
    reader = _text_reader(spark, found, empty, multi_line).option("header", True).option("enforceSchema", False)
    return reader.csv(path).withColumn(_HEAD, F.lit(False)), names or found, empty


def _present(name: str, empty: str, null_tokens: Sequence[str], is_text: bool) -> Column:
    """The field as text; NULL where it is missing."""
    text = F.col(f"`{name}`")
    quoted_empty = F.lit("") if is_text else F.lit(None).cast("string")
    return F.when(text == empty, quoted_empty).when(text.isin(*[t for t in null_tokens if t]), None).otherwise(text)


def _typed(text: Column, field: T.StructField) -> Column:
    return text if isinstance(field.dataType, T.StringType) else F.trim(text).try_cast(field.dataType)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
    header: bool = True,
    multi_line: bool = False,
    with_corrupt: bool = False,
    headers: str = "by_file",
) -> DataFrame:
    """Typed rows by header name (by position without a header).

    A bad record fails the job unless ``with_corrupt`` is set: then rows get
    ``_corrupt_record``, the text of a record that has a value of the wrong type
    or a wrong number of fields, NULL for a good one.
    """
    names = [f.name for f in schema.fields]
    records = _text_records(spark, path, names, header, multi_line, headers)
    return _typed_rows(records, schema, null_tokens, with_corrupt)


def _typed_rows(records: tuple[DataFrame, list[str], str], schema: T.StructType, null_tokens: Sequence[str], with_corrupt: bool) -> DataFrame:
    """``_text_records`` with the types of ``schema``."""
    raw, _, empty = records
    names = [f.name for f in schema.fields]
    values, wrong = [], F.col(_RAW).isNotNull()
    for f in schema.fields:
        text = _present(f.name, empty, null_tokens, isinstance(f.dataType, T.StringType))
        values.append(_typed(text, f).alias(f.name))
        wrong = wrong | (text.isNotNull() & _typed(text, f).isNull())
    shown = F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names])
    # Catalyst may test records before it drops the headers, so those are never bad
    record = F.when(~F.col(_HEAD) & wrong, F.coalesce(F.col(_RAW), F.replace(shown, F.lit(empty), F.lit(""))))
    out = raw.where(~F.col(_HEAD))
    if with_corrupt:
        return out.select(*values, record.alias(CORRUPT))
    # made by a generator, so that Catalyst does not write the test of a record out a
    # second time below its values: in one method the two are too long to be compiled
    out = out.select(F.inline(F.array(F.struct(*values, record.alias(CORRUPT)))))
    bad = F.raise_error(F.concat(F.lit("bad CSV record: "), F.col(CORRUPT))).cast("boolean")
    return out.where(F.when(F.col(CORRUPT).isNotNull(), bad).otherwise(True)).select(*[F.col(f"`{n}`") for n in names])


def infer_csv_types(
    spark: SparkSession,
    path: str,
    null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
    names: Sequence[str] | None = None,
    header: bool = True,
    multi_line: bool = False,
    headers: str = "by_file",
) -> DataFrame:
    """One row per column, from all rows: ``position``, ``name``, ``type``, ``n_rows``,
    ``n_missing`` and the values that are a boolean, an integer (of 64 bits), a
    number or a date. A column without values is text."""
    records = _text_records(spark, path, None if names is None else list(names), header, multi_line, headers)
    return _inferred(spark, records, null_tokens)


def _inferred(spark: SparkSession, records: tuple[DataFrame, list[str], str], null_tokens: Sequence[str]) -> DataFrame:
    """The types of ``_text_records``. Each field is a row of its place and text, so that
    one short expression tests the fields of all columns."""
    raw, names, empty = records
    if not names:
        told = "n_rows long, n_missing long, n_boolean long, n_integer long, n_number long, n_date long"
        return spark.createDataFrame([], f"position int, name string, type string, {told}")
    texts = [_present(name, empty, null_tokens, is_text=True) for name in names]
    fields = raw.where(~F.col(_HEAD)).select(F.posexplode(F.array(*texts)).alias("position", "text"))
    t = F.trim("text")
    fits = {
        "boolean": F.lower(t).isin("true", "false"),
        "bigint": t.rlike(_INTEGER) & t.try_cast("bigint").isNotNull(),
        "double": t.rlike(_NUMBER),
        "date": t.rlike(_DATE) & t.try_cast("date").isNotNull(),
    }
    found = fields.groupBy("position").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("text").isNull()).alias("missing"),
        *[F.count_if(c).alias(k) for k, c in fits.items()],
    )
    # columns of files without records have no fields
    columns = spark.createDataFrame(list(enumerate(names)), "position int, name string")
    found = columns.join(found, "position", "left").fillna(0)
    values = F.col("n_rows") - F.col("missing")
    kind = F.lit("string")
    for k in reversed(list(_LATTICE)):
        kind = F.when((values > 0) & (F.col(k) == values), k).otherwise(kind)
    return found.select(
        "position",
        "name",
        kind.alias("type"),
        "n_rows",
        F.col("missing").alias("n_missing"),
        F.col("boolean").alias("n_boolean"),
        F.col("bigint").alias("n_integer"),
        F.col("double").alias("n_number"),
        F.col("date").alias("n_date"),
    )


def csv_schema(inferred: DataFrame) -> T.StructType:
    """The schema of an ``infer_csv_types`` frame; a row per column is collected."""
    rows = inferred.select("position", "name", "type").orderBy("position").collect()
    return T.StructType([T.StructField(r["name"], _LATTICE.get(r["type"], T.StringType())) for r in rows])


def read_csv_inferred(
    spark: SparkSession,
    path: str,
    null_tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
    multi_line: bool = False,
    headers: str = "by_file",
) -> DataFrame:
    """Rows with inferred types: one pass over the records infers, the other reads. With
    ``headers="by_file"`` the files are read and their records stored once for both."""
    records = _text_records(spark, path, None, True, multi_line, headers)
    return _typed_rows(records, csv_schema(_inferred(spark, records, null_tokens)), null_tokens, False)


def split_csv(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without ``_corrupt_record``, and bad rows with it."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull())


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header line per part file; texts quoted, NULL written as nothing.

    Spark's CSV writer quotes NULL along with all other fields or leaves blanks
    and line breaks to the reader's mercy, so the records are composed here and
    written as text. The first row of each part brings the header.
    """
    fields = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`").cast("string")
        if isinstance(f.dataType, T.StringType):
            c = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        fields.append(F.coalesce(c, F.lit("")))
    head = ",".join('"' + n.replace('"', '""') + '"' for n in df.columns)
    record = F.concat_ws(",", *fields)
    row_of_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    value = F.when(row_of_part == 0, F.concat(F.lit(head + "\n"), record)).otherwise(record)
    # one file a task, whatever the session says: a further file would lack the header
    df.select(value.alias("value")).write.mode(mode).option("maxRecordsPerFile", 0).text(path)
