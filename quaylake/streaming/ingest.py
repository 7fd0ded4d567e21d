"""Event stream ingest: source -> JSON decode -> checkpointed append sink.

The decode step is ``quaylake.functions.events.decode_events``, the same plan
the batch path uses. The source is Kafka when its connector is on the class
path (``format='kafka'``), or a folder of JSON text files (``format='text'``),
which exposes the same ``value`` column. The sink appends to a table or a
path with a checkpoint location, so a restart resumes from the offset log and
re-ingests nothing, wherever the run before it ended.

Kafka starts at its own ``startingOffsets``. A folder has no such option: to start
it at the latest file, ``start_ingest`` first runs one batch without rows on a
checkpoint that has no commit yet. It lists the files as opaque ones, so that
they enter the offset log and none is opened, and writes no row to the sink.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from quaylake.functions.events import decode_events

DEFAULT_TRIGGER = "5 seconds"
_FILE = "path string, modificationTime timestamp, length long, content binary"
#: seconds between two looks at the progress of a bounded run
POLL_SECONDS = 0.1


def event_source(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame with a ``value`` column of JSON payloads. ``starting_offsets``:
    ``latest`` (the default of Kafka) or ``earliest`` (that of files, which start at
    the latest through ``start_ingest`` only)."""
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets or "latest")
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()
    if fmt == "text":
        if starting_offsets not in (None, "earliest"):
            raise ValueError(f"a file source cannot start at {starting_offsets!r}; see start_ingest")
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(path)
    raise ValueError(f"unsupported stream source {fmt!r}")


def decoded_stream(source: DataFrame, schema: T.StructType, on_malformed: str = "keep") -> DataFrame:
    return decode_events(source, schema, on_malformed=on_malformed)


def start_append(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    name: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append-mode sink with a checkpoint; processing-time trigger, or
    ``available_now`` to drain what is there and stop. ``options`` go to the
    sink (e.g. ``kafka.bootstrap.servers`` and ``topic`` for ``fmt='kafka'``
    with a frame from ``encode_events``)."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if table:
        return writer.toTable(table)
    return writer.start(path)


@dataclass(frozen=True)
class Progress:
    """What a bounded run did: batches with rows, their rows, and why it ended
    (``batches``, ``rows``, ``timeout`` or ``ended``)."""

    batches: int
    rows: int
    reason: str


def _progress(query: StreamingQuery, seen: dict[int, int]) -> tuple[int, int]:
    for p in query.recentProgress:
        if p["numInputRows"]:
            seen[p["batchId"]] = p["numInputRows"]
    return len(seen), sum(seen.values())


def run_bounded(
    query: StreamingQuery, timeout_s: float | None = None, max_batches: int | None = None, max_rows: int | None = None
) -> Progress:
    """Wait until the query ends, has done ``max_batches`` micro-batches with rows or
    ``max_rows`` input rows by its progress reports, or ``timeout_s`` is over,
    whichever comes first; then stop it. The batch that runs meanwhile may still
    be added, or is done again by the next run on the checkpoint. A query that
    failed by itself raises its error; one that was stopped inside a step of its
    log does not, as the next run finds it as after a crash."""
    begin, seen, reason = time.monotonic(), {}, "ended"
    while query.isActive:
        batches, rows = _progress(query, seen)
        if max_batches is not None and batches >= max_batches:
            reason = "batches"
        elif max_rows is not None and rows >= max_rows:
            reason = "rows"
        elif timeout_s is not None and time.monotonic() - begin >= timeout_s:
            reason = "timeout"
        else:
            query.awaitTermination(POLL_SECONDS)
            continue
        break
    error = query.exception() if reason == "ended" else None
    query.stop()
    if error is not None:
        raise error
    return Progress(*_progress(query, seen), reason)


def has_committed(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a query on this checkpoint has finished a batch."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    return any(not f.getPath().getName().startswith(".") for f in fs.listStatus(path))


def start_ingest(
    spark: SparkSession,
    source_path: str,
    checkpoint: str,
    schema: T.StructType,
    path: str | None = None,
    table: str | None = None,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
    on_malformed: str = "keep",
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the ingest of a folder of JSON text files. ``starting_offsets='latest'``
    passes over what is there when the checkpoint is first used; later starts
    resume, whatever it says."""
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError(f"starting_offsets must be 'earliest' or 'latest', not {starting_offsets!r}")
    stream = decoded_stream(event_source(spark, fmt="text", path=source_path, max_per_trigger=max_per_trigger), schema, on_malformed)
    if starting_offsets == "latest" and not has_committed(spark, checkpoint):
        listed = spark.readStream.format("binaryFile").schema(_FILE).load(source_path).where(F.col("path").isNull())
        nothing = listed.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields])
        start_append(nothing, checkpoint, path=path, table=table, available_now=True).awaitTermination()
    return start_append(stream, checkpoint, path=path, table=table, trigger=trigger, available_now=available_now)


def ingest_available(
    spark: SparkSession,
    source_path: str,
    sink_path: str,
    checkpoint: str,
    schema: T.StructType,
    on_malformed: str = "keep",
) -> StreamingQuery:
    """Drain the JSON text files under ``source_path`` into ``sink_path`` once
    (availableNow) and wait; a later call with the same checkpoint only
    ingests files that arrived since."""
    query = start_ingest(spark, source_path, checkpoint, schema, path=sink_path, on_malformed=on_malformed, available_now=True)
    query.awaitTermination()
    return query
