"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import quaylake
from quaylake.session import scratch_path, shared_dir

_SHIPPED: set[str] = set()


#: rows of an Arrow batch, unless the session says otherwise
ARROW_ROWS = 1000
_ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their
    Python workers can import it wherever it is installed on the driver.

    Spark's 10,000 rows a batch are tens of megabytes of whole documents, held
    several times over beside the heap; where the session does not set a size,
    it is set to ``ARROW_ROWS``.
    """
    if spark.conf.get(_ARROW_ROWS_KEY, None) is None:
        spark.conf.set(_ARROW_ROWS_KEY, str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(quaylake.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quaylake-"), "quaylake.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def position(df: DataFrame, name: str) -> int:
    """Place of a column: the first of exactly that name, else the only one that
    has it in other letters."""
    if name in df.columns:
        return df.columns.index(name)
    near = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(near) != 1:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return near[0]


def only(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The named columns alone (``new="old"`` renames). Columns are taken by place,
    so that others whose names clash with them or with each other do no harm."""
    wanted = {n: n for n in names} | renamed
    places = {new: position(df, old) for new, old in wanted.items()}
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{i}").alias(new) for new, i in places.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


ROWS_PER_FILE = 200_000
#: bytes of a plan's estimated output that a partition is left with
PLANNED_BYTES = 4 << 20


def fewer(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in no more partitions than its rows fill, where an upper bound of them is
    known, else in a few per core if the planner's estimate of its bytes is small: a
    small table written by every shuffle partition would be as many tiny files. The
    estimate grows with the input, so partitions of large tables stay as they are."""
    if rows is not None:
        return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    planned = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    some = 4 * df.sparkSession.sparkContext.defaultParallelism
    needed = -(-planned // PLANNED_BYTES)
    return df.coalesce(some) if needed <= some else df


def tidy(task):
    """An Arrow task that gives freed memory back to the system when it ends: a
    Python worker lives on between stages, beside the executor's heap."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            _give_back()

    return run


def _give_back() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_STATE: dict = {}


def worker_state(name, make):
    """What a Python worker keeps between tasks under ``name``; what another operator
    kept there before is let go, so that a worker holds one such table at a time."""
    if name not in _STATE:
        _STATE.clear()
        _STATE[name] = make()
    return _STATE[name]


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and
    outlives executors. ``rows``: an upper bound of its rows, if known."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    fewer(df, rows).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


__all__ = ["fewer", "free_name", "only", "position", "scratch_path", "shared_dir", "ship", "shuffle_width", "stored", "tidy", "worker_state"]
