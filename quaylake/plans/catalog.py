"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the scale-factor tables (or tables Spark derives from
them) in full; the SQL twin of each key is in ``quaylake.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions.events import decode_events, encode_events, json_field
from quaylake.functions.shipments import derive_revenue as revenue_rule
from quaylake.operators import dml, evolve, kpi_parts, kpis, partitions, versions
from quaylake.operators.quality import report
from quaylake.operators.quality import validate as V
from quaylake.operators.quality.gate import DEFAULT_THRESHOLD, gate, gated_load, gated_rows
from quaylake.operators.quality.rules import between, retail_suite, unique
from quaylake.operators.quality.run import validate_batch
from quaylake.plans import lab
from quaylake.plans.broadcast import join_small
from quaylake.schemas import DELIVERY_RATING, RETAIL_ORDER_SCHEMA, SHIPMENT_SCHEMA
from quaylake.session import scratch_path
from quaylake.sources import catalog as ddl
from quaylake.sources import fixtures, results_io
from quaylake.sources.csv_io import CORRUPT, infer_csv_types, read_csv, read_csv_inferred, write_csv
from quaylake.sources.tables import read_table
from quaylake.streaming import faults
from quaylake.streaming.ingest import decoded_stream, event_source, ingest_available, run_bounded, start_append, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

MERGE_SET = {"status": "status", "timestamp": "timestamp"}  # WHEN MATCHED SET
LOW_THRESHOLD = 80.0


# ---------------------------------------------------------------- quality
def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.annotate(fixtures.retail_orders(spark, sf_dir), retail_suite(fixtures.AS_OF_DATE))


def dq_rule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.rule_stats(_annotated(spark, sf_dir), retail_suite(fixtures.AS_OF_DATE))


def dq_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.batch_stats(_annotated(spark, sf_dir))


def dq_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.clean_rows(_annotated(spark, sf_dir))


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.quarantine_rows(_annotated(spark, sf_dir))


def dq_reasons_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.reasons_long(_annotated(spark, sf_dir))


def dq_split_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows as ``batch LEFT ANTI JOIN failed rows``.

    The row identity is the whole row under null-safe equality: identical rows
    fail the same rules (uniqueness included), so the anti join is exact as a
    bag. Failed rows are de-duplicated first (partial aggregation collapses a
    hot repeated row) and the set is broadcast only when measured small."""
    base = fixtures.retail_orders(spark, sf_dir)
    cols = base.columns
    failed = V.quarantine_rows(V.annotate(base, retail_suite(fixtures.AS_OF_DATE))).select(*cols).distinct()

    def same_row(big: DataFrame, small: DataFrame):
        cond = big[cols[0]].eqNullSafe(small[cols[0]])
        for c in cols[1:]:
            cond = cond & big[c].eqNullSafe(small[c])
        return cond

    return join_small(base, failed, same_row, "left_anti")


def dq_between_two_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [between("quantity", 1, 5)]
    return V.rule_failures(V.annotate(fixtures.retail_orders(spark, sf_dir), rules), rules, 0)


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate(dq_batch_stats(spark, sf_dir), DEFAULT_THRESHOLD)


def _gated(threshold: float) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ann = _annotated(spark, sf_dir)
        return gated_rows(V.clean_rows(ann), V.batch_stats(ann), threshold)

    return run


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.rule_stats(_annotated(spark, sf_dir), retail_suite(fixtures.AS_OF_DATE), with_kwargs=True)


def dq_report_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_checks(_results(spark, sf_dir))


def dq_report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = _annotated(spark, sf_dir)
    return report.report_summary(V.rule_stats(ann, retail_suite(fixtures.AS_OF_DATE)), V.batch_stats(ann))


def dq_results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results document written as JSON and read back, one row per rule."""
    path = scratch_path(spark, "results_json")
    results_io.write_results(results_io.results_document(_results(spark, sf_dir)), path)
    return results_io.read_results(spark, path).drop("kwargs")


def dq_results_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results document read as a VARIANT: one row per rule and argument."""
    path = scratch_path(spark, "results_json")
    results_io.write_results(results_io.results_document(_results(spark, sf_dir)), path)
    return results_io.read_arguments(spark, path)


def dq_validate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written run: one job splits the batch into clean / quarantine
    partitions; the quarantined rows are read back from the written table."""
    out = scratch_path(spark, "validation")
    return validate_batch(spark, fixtures.retail_orders(spark, sf_dir), retail_suite(fixtures.AS_OF_DATE), out).quarantine


def _with_odd_texts(batch: DataFrame) -> DataFrame:
    """The batch with product ids that a CSV file can lose: blanks around, quotes,
    commas, line breaks, a backslash, the empty text."""
    product, kind = F.col("product_id"), F.length("customer_id") + F.length("product_id")
    return batch.withColumn(
        "product_id",
        F.when(kind % 7 == 1, F.concat(F.lit("  "), product, F.lit(" ")))
        .when(kind % 7 == 2, F.concat(F.lit('say "'), product, F.lit('", ok')))
        .when(kind % 7 == 3, F.concat(product, F.lit("\nsecond line")))
        .when(kind % 7 == 4, "")
        .when(kind % 7 == 5, F.concat(F.lit("back\\"), product))
        .otherwise(product),
    )


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail batch written as CSV in another column order, with odd texts and
    some quantities that are no numbers, and read by header name. Records that
    do not fit are told apart and keep what could be read."""
    batch = _with_odd_texts(fixtures.retail_orders(spark, sf_dir))
    quantity = F.when(F.col("quantity") == 7, "seven").otherwise(F.col("quantity").cast("string"))
    path = scratch_path(spark, "retail_csv")
    write_csv(batch.withColumn("quantity", quantity).select(*reversed(batch.columns)), path)
    rows = read_csv(spark, path, RETAIL_ORDER_SCHEMA, multi_line=True, with_corrupt=True, headers="same")
    return rows.withColumn("is_bad", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows with odd texts and their reasons through the CSV sink and
    source."""
    path = scratch_path(spark, "quarantine_csv")
    write_csv(_with_odd_texts(V.quarantine_rows(_annotated(spark, sf_dir))), path)
    schema = T.StructType(list(RETAIL_ORDER_SCHEMA.fields) + [T.StructField(V.REASONS, T.StringType(), True)])
    return read_csv(spark, path, schema, multi_line=True, headers="same")


def _mixed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The retail batch as CSV files of two column orders, with a flag, a missing token
    for some quantities and whole numbers among the prices."""
    batch = fixtures.retail_orders(spark, sf_dir)
    batch = batch.withColumn("is_bulk", (F.col("quantity") > 5).cast("string"))
    price = F.when(F.col("price") == 0, "0").otherwise(F.col("price").cast("string"))
    texts = batch.withColumn("quantity", F.when(F.col("quantity") == 7, "NA").otherwise(F.col("quantity").cast("string"))).withColumn("price", price)
    path = scratch_path(spark, "mixed_csv")
    bulk = F.coalesce(F.col("is_bulk") == "true", F.lit(False))
    write_csv(texts.where(~bulk), path, mode="append")
    write_csv(texts.where(bulk).select(*reversed(texts.columns)), path, mode="append")
    return path


def csv_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred types of a folder with two column orders, one row per column."""
    return infer_csv_types(spark, _mixed_csv(spark, sf_dir)).drop("position")


def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of that folder with inferred types."""
    return read_csv_inferred(spark, _mixed_csv(spark, sf_dir))


def dq_unique_later_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows failing a uniqueness rule on a numeric column that is not the first one
    and holds NaN: columns keep their order, NaN is missing."""
    batch = fixtures.retail_orders(spark, sf_dir)
    price = F.when(F.col("quantity") == 3, F.lit(float("nan"))).otherwise(F.round("price", -2))
    rules = [unique("price")]
    return V.rule_failures(V.annotate(batch.withColumn("price", price), rules), rules, 0)


def dq_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One suite run, its clean rows loaded through the gate twice, as after a
    retry, and read back."""
    batch = fixtures.retail_orders(spark, sf_dir)
    run = validate_batch(spark, batch, retail_suite(fixtures.AS_OF_DATE), scratch_path(spark, "validation"), LOW_THRESHOLD)
    target = scratch_path(spark, "loaded")
    stats = run.batch_stats
    for _ in range(2):
        if not gated_load(run.clean, stats, target, LOW_THRESHOLD, batch_id="2001-06-30"):
            return run.clean.limit(0)
    return spark.read.schema(batch.schema).parquet(f"{target}/batch_id=2001-06-30")


# ------------------------------------------------------------- shipments
def scan_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab.read_shipments(spark, sf_dir)


def incoming_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.merge_source(spark, sf_dir)


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_summary(fixtures.shipments(spark, sf_dir))


def kpi_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_display(kpis.kpi_summary(fixtures.shipments(spark, sf_dir)))


def kpi_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_summary(fixtures.shipments(spark, sf_dir).drop("revenue", "weight"))


def kpi_empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The empty-table test on the shipments and on those of a status none has."""
    ships = fixtures.shipments(spark, sf_dir)
    some = kpis.is_empty(ships).withColumn("rows", F.lit("all"))
    return some.unionByName(kpis.is_empty(ships.where("status = 'Lost'")).withColumn("rows", F.lit("lost")))


def kpi_merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPIs from the parts of all days, without a look at the shipments."""
    return kpi_parts.merge_parts(spark.read.parquet(lab.kpi_part_table(spark, sf_dir)))


def kpi_months_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPIs of each month from the parts of its days."""
    month = ("month", F.substring(kpi_parts.PART, 1, 7))
    return kpi_parts.merge_parts(spark.read.parquet(lab.kpi_part_table(spark, sf_dir)), [month])


def revenue_by_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.revenue_by_destination(fixtures.shipments(spark, sf_dir))


def priority_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.priority_distribution(fixtures.shipments(spark, sf_dir))


def status_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.status_breakdown(fixtures.shipments(spark, sf_dir))


def dashboard_breakdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.breakdowns(fixtures.shipments(spark, sf_dir))


def recent_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.recent_shipments(fixtures.shipments(spark, sf_dir), 20)


def derive_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.shipments(spark, sf_dir)
    return s.select("shipment_id", "weight", "priority", revenue_rule(F.col("weight"), F.col("priority")).alias("revenue"))


# ----------------------------------------------------------------- events
def event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.shipments(spark, sf_dir)
    s = s.withColumn("vehicle_id", F.when(F.col("status") != "Delivered", F.col("vehicle_id")))
    return encode_events(s, key="shipment_id").withColumnRenamed("key", "shipment_id")


def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_events(encode_events(fixtures.shipments(spark, sf_dir)), SHIPMENT_SCHEMA)


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", json_field(F.col("props"), "k", "int").alias("k"))


# Malformed messages added to the event stream.
MALFORMED_LINES = ["not json", "", '{"shipment_id": "SH-STR", "weight": "12"}']


def _stream_input(spark: SparkSession, sf_dir: str) -> str:
    src = scratch_path(spark, "stream_in")
    encode_events(fixtures.shipments(spark, sf_dir)).write.mode("append").text(src)
    spark.createDataFrame([(x,) for x in MALFORMED_LINES], "value string").coalesce(1).write.mode("append").text(src)
    return src


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text stream -> decode -> checkpointed parquet append (availableNow)."""
    src = _stream_input(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    return spark.read.schema(SHIPMENT_SCHEMA).parquet(sink)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two restarts on one checkpoint: the second adds nothing, the third
    adds only the file that arrived in between."""
    src = _stream_input(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    encode_events(fixtures.merge_source(spark, sf_dir)).write.mode("append").text(src)
    ingest_available(spark, src, sink, ckpt, SHIPMENT_SCHEMA)
    return spark.read.schema(SHIPMENT_SCHEMA).parquet(sink)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Started at the latest file: what is there at the first start stays out; files
    that arrive while the stream runs or is down do not."""
    src = _stream_input(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")

    def run() -> None:
        query = start_ingest(spark, src, ckpt, SHIPMENT_SCHEMA, path=sink, starting_offsets="latest", available_now=True)
        query.awaitTermination()

    run()
    encode_events(fixtures.merge_source(spark, sf_dir)).write.mode("append").text(src)
    run()
    encode_events(fixtures.new_shipments(spark, sf_dir)).write.mode("append").text(src)
    run()
    return spark.read.schema(SHIPMENT_SCHEMA).parquet(sink)


def _in_files(spark: SparkSession, rows: DataFrame, src: str, n: int) -> None:
    encode_events(rows).repartition(n).write.mode("append").text(src)


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of two files: a first run stops after two of them, a second
    resumes for one, a third drains the rest."""
    src = _stream_input(spark, sf_dir)
    _in_files(spark, fixtures.merge_source(spark, sf_dir), src, 8)
    sink, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")

    def start(available_now: bool = False):
        return start_ingest(
            spark, src, ckpt, SHIPMENT_SCHEMA, path=sink, max_per_trigger=2, trigger="0 seconds", available_now=available_now
        )

    run_bounded(start(), timeout_s=120, max_batches=2)
    run_bounded(start(), timeout_s=120, max_batches=1)
    run_bounded(start(available_now=True))
    return spark.read.schema(SHIPMENT_SCHEMA).parquet(sink)


def stream_crash_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crashes after the write of a batch, once before its commit and once before
    the sink knows its files; restarts add each row once."""
    src = _stream_input(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")

    def run() -> None:
        run_bounded(start_ingest(spark, src, ckpt, SHIPMENT_SCHEMA, path=sink, max_per_trigger=3, available_now=True))

    run()
    faults.lose_commit(spark, ckpt)
    run()
    _in_files(spark, fixtures.merge_source(spark, sf_dir), src, 5)
    run()
    faults.lose_manifest(spark, ckpt, sink)
    run()
    return spark.read.schema(SHIPMENT_SCHEMA).parquet(sink)


def _own_table(spark: SparkSession, name: str, schema: T.StructType) -> str:
    """A new catalog table of our own, its files under the shared folder."""
    path = scratch_path(spark, name)
    table = f"quaylake_lab.{path.rsplit('/', 1)[1].replace('-', '_')}"
    ddl.ensure_database(spark, "quaylake_lab", scratch_path(spark, "lab"))
    ddl.ensure_table(spark, table, schema, location=path)
    return table


def _kept(spark: SparkSession, table: str, name: str) -> DataFrame:
    """The rows of a catalog table in a written copy; the table is dropped."""
    path = scratch_path(spark, name)
    rows = spark.table(table)
    rows.write.parquet(path)
    ddl.drop_table(spark, table)
    if ddl.table_exists(spark, table):
        raise RuntimeError(f"{table} is still there")
    return spark.read.schema(rows.schema).parquet(path)


def stream_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON stream into a catalog table by a short processing-time trigger; a second
    run after more files arrive adds what is new."""
    src, ckpt = _stream_input(spark, sf_dir), scratch_path(spark, "stream_table_ckpt")
    table = _own_table(spark, "stream_table", SHIPMENT_SCHEMA)

    def run() -> None:
        stream = decoded_stream(event_source(spark, fmt="text", path=src), SHIPMENT_SCHEMA)
        query = start_append(stream, ckpt, table=table, trigger="200 milliseconds")
        query.processAllAvailable()
        query.stop()

    run()
    encode_events(fixtures.merge_source(spark, sf_dir)).write.mode("append").text(src)
    run()
    return _kept(spark, table, "stream_rows")


def catalog_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a table, insert through a temp view, add a column, insert again, read
    and drop it."""
    table = _own_table(spark, "catalog_table", SHIPMENT_SCHEMA)
    view = table.replace(".", "_") + "_incoming"
    fixtures.shipments(spark, sf_dir).createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {table} SELECT * FROM {view}")
    evolve.add_columns_sql(spark, table, DELIVERY_RATING)
    fixtures.new_shipments(spark, sf_dir).withColumn(DELIVERY_RATING.name, F.lit(5)).createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {table} SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return _kept(spark, table, "catalog_rows")


# -------------------------------------------------------------------- DML
def _other_spelling(df: DataFrame) -> DataFrame:
    """Column names in capitals and weights as whole numbers."""
    return df.withColumn("weight", F.col("weight").cast("long")).toDF(*[c.upper() for c in df.columns])


def insert_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _other_spelling(fixtures.new_shipments(spark, sf_dir))
    return dml.insert_append(fixtures.shipments(spark, sf_dir), rows)


def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.update_where(fixtures.shipments(spark, sf_dir), lab.UPDATE_PREDICATE, lab.UPDATE_SET)


def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.delete_where(fixtures.shipments(spark, sf_dir), lab.DELETE_PREDICATE)


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _other_spelling(fixtures.merge_source(spark, sf_dir))
    return dml.merge_into(fixtures.shipments(spark, sf_dir), source, "shipment_id", MERGE_SET)


def merge_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.merge_into(fixtures.shipments(spark, sf_dir), fixtures.merge_source(spark, sf_dir), "shipment_id", None)


def merge_matched_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dml.merge_into(
        fixtures.shipments(spark, sf_dir), fixtures.merge_source(spark, sf_dir), "shipment_id", MERGE_SET, insert=False
    )


def merge_dup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated and NULL source keys that match nothing all insert."""
    return dml.merge_into(
        fixtures.shipments(spark, sf_dir), fixtures.duplicate_key_source(spark, sf_dir), "shipment_id", MERGE_SET
    )


def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge into a bucketed table, which stays where it is."""
    target = spark.table(lab.bucketed_shipments(spark, sf_dir))
    return dml.merge_into(target, fixtures.merge_source(spark, sf_dir), "shipment_id", MERGE_SET, buckets=lab.BUCKETS)


def _by_origin(spark: SparkSession, sf_dir: str) -> evolve.Layout:
    """The shipments in a table of their own, partitioned by origin."""
    table = evolve.Layout(scratch_path(spark, "by_origin"), ("origin",))
    evolve.write_layout(fixtures.shipments(spark, sf_dir), table)
    return table


def merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge, update and delete that rewrite the partitions with changed rows only."""
    table = _by_origin(spark, sf_dir)
    source = fixtures.merge_source(spark, sf_dir)
    some = source.where(F.col("origin").isin("NATION_1", "NATION_2", "NATION_3"))
    partitions.merge_partitions(spark, table, SHIPMENT_SCHEMA, some, "shipment_id", MERGE_SET)
    moved = {"origin": F.lit("NATION_7"), "weight": F.col("weight") + 1}
    partitions.update_partitions(spark, table, SHIPMENT_SCHEMA, "origin = 'NATION_6' AND priority = 'High'", moved)
    partitions.delete_partitions(spark, table, SHIPMENT_SCHEMA, "origin = 'NATION_14' OR (origin = 'NATION_17' AND status = 'Delivered')")
    return evolve.read_layouts(spark, [table], SHIPMENT_SCHEMA)


# ------------------------------------------------------------- versioning
def as_of_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.as_of(*lab.shipment_log(spark, sf_dir), lab.AS_OF_MONTH)


def as_of_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.current(lab.shipment_log(spark, sf_dir)[0])


def first_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as of its earliest commit by time; two at least are required."""
    log, commits = lab.shipment_log(spark, sf_dir)
    return versions.as_of(log, commits, versions.first_commit(commits))


def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.history(lab.shipment_log(spark, sf_dir)[1])


def commit_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.snapshots(lab.shipment_log(spark, sf_dir)[1], flat=True)


def commit_snapshot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary map of each snapshot, one row per key."""
    return versions.snapshot_summary(lab.shipment_log(spark, sf_dir)[1])


# -------------------------------------------------------------- evolution
def add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old files read under the evolved schema, then the new column set."""
    schema = evolve.evolved_schema(SHIPMENT_SCHEMA, DELIVERY_RATING)
    table = evolve.read_declared(spark, lab.shipments_table(spark, sf_dir), schema)
    rated = dml.update_where(table, F.col("status") == "Delivered", {"delivery_rating": 5})
    return rated.select("shipment_id", "status", "delivery_rating")


def partition_evolved_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolve.read_layouts(spark, lab.evolved_layouts(spark, sf_dir), SHIPMENT_SCHEMA)


def partition_evolved_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments from the nations of a region, over both layouts: the join prunes."""
    nation = read_table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").where("r_name = 'ASIA'").select("r_regionkey", "r_name")
    origins = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    origins = origins.select(F.col("n_name").alias("origin"), F.col("r_name").alias("region"))
    return evolve.read_layouts_of(spark, lab.clustered_layouts(spark, sf_dir), SHIPMENT_SCHEMA, "origin", origins)


# ---------------------------------------------------------------- registry
_PER_RULE_KEYS = [
    "dq_order_id_not_null",
    "dq_order_id_unique",
    "dq_product_id_not_null",
    "dq_customer_id_not_null",
    "dq_price_min",
    "dq_quantity_min",
    "dq_email_regex",
    "dq_date_max",
]


def _rule_query(index: int) -> Query:
    """Rows failing one rule of the suite. Only that rule is evaluated, so a
    row-level rule costs one narrow scan: the duplicate-key aggregation runs
    for the uniqueness rule alone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule = [retail_suite(fixtures.AS_OF_DATE)[index]]
        return V.rule_failures(V.annotate(fixtures.retail_orders(spark, sf_dir), rule), rule, 0)

    return run


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # data quality
        "dq_rule_stats": dq_rule_stats,
        "dq_batch_stats": dq_batch_stats,
        "dq_clean": dq_clean,
        "dq_quarantine": dq_quarantine,
        "dq_reasons_long": dq_reasons_long,
        "dq_split_semi_anti": dq_split_semi_anti,
        "dq_between_two_sided": dq_between_two_sided,
        "dq_gate": dq_gate,
        "dq_gated_load": _gated(DEFAULT_THRESHOLD),
        "dq_gated_load_low_threshold": _gated(LOW_THRESHOLD),
        "dq_load_twice": dq_load_twice,
        "dq_unique_later_column": dq_unique_later_column,
        "dq_report_checks": dq_report_checks,
        "dq_report_summary": dq_report_summary,
        "dq_results_json": dq_results_json,
        "dq_results_arguments": dq_results_arguments,
        "dq_validate_batch": dq_validate_batch,
        "csv_scan": csv_scan,
        "csv_roundtrip": csv_roundtrip,
        "csv_inferred_schema": csv_inferred_schema,
        "csv_inferred_scan": csv_inferred_scan,
        # shipments: scans, KPIs, top-k
        "scan_shipments": scan_shipments,
        "incoming_batch": incoming_batch,
        "kpi_summary": kpi_summary,
        "kpi_merged_parts": kpi_merged_parts,
        "kpi_months_from_parts": kpi_months_from_parts,
        "kpi_display": kpi_display,
        "kpi_missing_column": kpi_missing_column,
        "kpi_empty_table": kpi_empty_table,
        "revenue_by_destination": revenue_by_destination,
        "priority_distribution": priority_distribution,
        "status_breakdown": status_breakdown,
        "recent_shipments": recent_shipments,
        "dashboard_breakdowns": dashboard_breakdowns,
        "derive_revenue": derive_revenue,
        # events and streams
        "event_encode": event_encode,
        "event_decode": event_decode,
        "json_props": json_props,
        "stream_ingest": stream_ingest,
        "stream_restart": stream_restart,
        "stream_versioned": stream_versioned,
        "stream_latest": stream_latest,
        "stream_bounded": stream_bounded,
        "stream_crash_restart": stream_crash_restart,
        "catalog_lifecycle": catalog_lifecycle,
        # DML
        "insert_append": insert_append,
        "update_where": update_where,
        "delete_where": delete_where,
        "merge_upsert": merge_upsert,
        "merge_new_only": merge_new_only,
        "merge_matched_only": merge_matched_only,
        "merge_dup_source": merge_dup_source,
        "merge_bucketed": merge_bucketed,
        "merge_partitions": merge_partitions,
        # versions
        "as_of_commit": as_of_commit,
        "as_of_latest": as_of_latest,
        "first_commit": first_commit,
        "commit_history": commit_history,
        "commit_snapshots": commit_snapshots,
        "commit_snapshot_summary": commit_snapshot_summary,
        # evolution
        "add_column": add_column,
        "partition_evolved_read": partition_evolved_read,
        "partition_evolved_pruned": partition_evolved_pruned,
    }
    for i, key in enumerate(_PER_RULE_KEYS):
        q[key] = _rule_query(i)
    return q
