"""Queries over the driver tables, one or more per operator.

Each takes the session and the folder of a scale factor and returns a DataFrame.
Queries about files, tables and streams first write what they read, in a
fresh folder and schema of the shared storage.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakemill.catalogue import bindings as b
from lakemill.config import MissionRun, RetailRun
from lakemill.operators import flatten
from lakemill.operators.relate import orphan_rows, union_labelled
from lakemill.plans import bronze, gold, medallion, missions, quality, silver
from lakemill.schemas import INGEST_TS, MISSION_COLUMNS, RETAIL_COLUMNS
from lakemill.sinks import (
    append_table,
    cluster_table,
    convert_csv,
    convert_each_csv,
    create_schema,
    empty_table_like as make_empty_table,
    export_parquet,
    replace_table,
    write_csv,
    write_flat_csv,
    write_flat_parquet,
    write_path,
    zorder_table,
)
from lakemill.sources import (
    files_as_table,
    read_documents,
    read_flat_csv,
    read_index,
    read_parquet,
    read_split_csv,
    read_table,
)
from lakemill.storage import move_single_files, shared_folder
from lakemill.streaming import arriving_files, bulk_load, drain_into, ingest_available, ingest_shapes, load_new_files, run_into

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, which the SQL side returns as well."""
    return df.withColumns({
        f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, DecimalType)
    })


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: _comparable(function(spark, sf_dir))
    return function


def _as_text(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """A time as text, which is the same on both sides whatever the types of time are."""
    return df.withColumn(column, F.date_format(column, pattern))


def _scratch(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A fresh folder and a fresh schema whose managed tables live in it."""
    folder = shared_folder(spark, purpose)
    schema = posixpath.basename(folder).replace("-", "_")
    create_schema(spark, schema, f"{folder}/tables")
    return folder, schema


# --- gold ----------------------------------------------------------------------------


@_query
def daily_revenue(spark, sf):
    return gold.daily_revenue(b.orders(spark, sf), b.sales(spark, sf))


@_query
def daily_revenue_latest10(spark, sf):
    return gold.latest_days(daily_revenue(spark, sf))


@_query
def top_products(spark, sf):
    return gold.top_products(b.sales(spark, sf), b.products(spark, sf))


@_query
def top_products_top20(spark, sf):
    return gold.ranked_products(top_products(spark, sf), 20)


@_query
def customer_360(spark, sf):
    return gold.customer_360(b.customers(spark, sf), b.orders(spark, sf), b.sales(spark, sf))


# --- silver --------------------------------------------------------------------------


@_query
def silver_customers(spark, sf):
    return _as_text(silver.silver_customers(b.raw_customers(spark, sf)), INGEST_TS)


@_query
def silver_products(spark, sf):
    return _as_text(silver.silver_products(b.raw_products(spark, sf)), INGEST_TS)


@_query
def silver_orders_latest(spark, sf):
    return _as_text(silver.silver_orders(b.raw_orders(spark, sf)), INGEST_TS)


@_query
def silver_sales_typed(spark, sf):
    return _as_text(silver.silver_sales(b.raw_sales(spark, sf)), INGEST_TS)


@_query
def silver_sales_latest(spark, sf):
    return _as_text(silver.silver_sales(b.raw_sales(spark, sf), dedupe=True), INGEST_TS)


@_query
def silver_orders_distinct(spark, sf):
    return silver.distinct_orders(b.raw_orders(spark, sf))


@_query
def silver_orders_replaced(spark, sf):
    _, schema = _scratch(spark, "silver")
    replace_table(b.products(spark, sf), f"{schema}.orders")
    replace_table(silver.distinct_orders(b.raw_orders(spark, sf)), f"{schema}.orders")
    return read_table(spark, f"{schema}.orders")


# --- quality -------------------------------------------------------------------------


@_query
def dq_row_counts(spark, sf):
    raw = b.raw_tables(spark, sf)
    conformed = {
        "customers": silver.silver_customers(raw["customers"]),
        "products": silver.silver_products(raw["products"]),
        "orders": silver.silver_orders(raw["orders"]),
        "sales": silver.silver_sales(raw["sales"]),
    }
    return quality.layer_row_counts(raw, conformed)


@_query
def dq_row_counts_distinct(spark, sf):
    return quality.distinct_row_counts(
        b.raw_sales(spark, sf), b.sales(spark, sf), b.orders(spark, sf), b.raw_orders(spark, sf)
    )


@_query
def dq_pk_not_null(spark, sf):
    return quality.missing_keys(b.with_key_gaps(b.silver_tables(spark, sf)))


@_query
def dq_uniqueness(spark, sf):
    return quality.key_uniqueness(b.with_key_gaps(b.silver_tables(spark, sf)))


@_query
def dq_orphan_orders_customers(spark, sf):
    return quality.orphan_orders_customers(b.orders(spark, sf), b.customers(spark, sf))


@_query
def dq_orphan_sales_orders(spark, sf):
    return quality.orphan_sales_orders(b.sales(spark, sf), b.orders(spark, sf))


@_query
def dq_orphan_sales_products(spark, sf):
    return quality.orphan_sales_products(b.sales(spark, sf), b.products(spark, sf))


@_query
def dq_orphan_order_rows(spark, sf):
    return orphan_rows(b.orders(spark, sf), b.customers(spark, sf), "customer_id")


@_query
def dq_order_status(spark, sf):
    return quality.status_profile(b.orders(spark, sf))


@_query
def dq_numeric_sanity(spark, sf):
    return quality.numeric_sanity(b.sales(spark, sf))


@_query
def dq_line_total_mismatch(spark, sf):
    return quality.mismatched_line_totals(b.sales(spark, sf))


def _finished(lines: DataFrame) -> DataFrame:
    """The lines a mart built before the open ones arrived would have seen."""
    return lines.where(F.col("line_status") == "F")


@_query
def dq_reconcile_daily(spark, sf):
    orders, lines = b.orders(spark, sf), b.sales(spark, sf)
    return quality.reconcile_daily(gold.daily_revenue(orders, _finished(lines)), orders, lines)


@_query
def dq_reconcile_products(spark, sf):
    lines = b.sales(spark, sf)
    stale = gold.top_products(_finished(lines), b.products(spark, sf))
    return quality.reconcile_products(stale, lines)


_AS_OF = "2024-06-01 00:00:00"


def _logged(results: DataFrame) -> DataFrame:
    return results.withColumn("check_ts", F.date_format("check_ts", "yyyy-MM-dd HH:mm:ss"))


@_query
def dq_results_log(spark, sf):
    _, schema = _scratch(spark, "dq")
    orders = silver.silver_orders(b.raw_orders(spark, sf))
    lines = silver.silver_sales(b.raw_sales(spark, sf))
    checks = quality.silver_checks(orders, lines, _AS_OF)
    quality.store_results(checks, f"{schema}.dq_results")
    return _logged(quality.latest_results(read_table(spark, f"{schema}.dq_results")))


@_query
def dq_battery(spark, sf):
    tables = b.silver_tables(spark, sf)
    orders, lines = tables["orders"], tables["sales"]
    stale = _finished(lines)
    marts = {
        "daily_revenue": gold.daily_revenue(orders, stale),
        "top_products": gold.top_products(stale, tables["products"]),
    }
    return _logged(quality.battery(tables, marts, _AS_OF))


# --- documents -----------------------------------------------------------------------


@_query
def flatten_documents(spark, sf):
    return flatten.flatten_documents(b.mission_documents(spark, sf))


@_query
def flatten_rejects(spark, sf):
    return flatten.rejected_documents(b.mission_documents(spark, sf))


@_query
def flatten_file_counts(spark, sf):
    return flatten.document_report(b.mission_documents(spark, sf))


@_query
def flatten_quality_summary(spark, sf):
    rows = flatten.flat_columns(flatten.flatten_documents(b.mission_documents(spark, sf)))
    return missions.quality_summary(missions.quality_flags(missions.curated(missions.clean(rows))))


def _one_file_per_row(texts: DataFrame, folder: str) -> str:
    """Write each text to a file of its own, with all cores."""
    cores = texts.sparkSession.sparkContext.defaultParallelism
    texts.repartition(cores).write.option("maxRecordsPerFile", 1).text(folder)
    return folder


def _supplier_files(spark, sf):
    """A document file for every supplier, named in no particular way."""
    suppliers = b.table(spark, sf, "supplier")
    document = F.to_json(F.struct(F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("identifier")))
    return _one_file_per_row(suppliers.select(document), shared_folder(spark, "documents"))


@_query
def documents_from_pattern(spark, sf):
    folder = _supplier_files(spark, sf)
    found = read_documents(spark, f"{folder}/part-*.txt")
    one = found.agg(F.min("file_path").alias("path")).first()["path"]
    single = read_documents(spark, one)
    return union_labelled([
        df.agg(F.count("*").alias("documents")).select(F.lit(via).alias("via"), "documents")
        for via, df in (("pattern", found), ("single file", single))
    ])


@_query
def no_documents(spark, sf):
    folder = _supplier_files(spark, sf)
    error = None
    try:
        read_documents(spark, folder, ".json")
    except FileNotFoundError as refused:
        error = type(refused).__name__
    files = read_documents(spark, folder, ".txt").agg(F.count("*").alias("other_files"))
    return files.withColumn("error", F.lit(error).cast("string"))


@_query
def flatten_in_order(spark, sf):
    rows = flatten.in_document_order(flatten.flatten_documents(b.mission_documents(spark, sf)), "doc_id")
    numbered = rows.select("doc_id", "person_pos", "role_pos", "role", F.monotonically_increasing_id().alias("at"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("at"))
    return numbered.withColumn("nth", nth).drop("at")


@_query
def documents_from_files(spark, sf):
    suppliers = b.table(spark, sf, "supplier")
    document = F.to_json(
        F.struct(
            F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("identifier"),
            F.array(F.struct(
                F.col("s_name").alias("institution"),
                F.array(F.lit("Owner"), F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string"))).alias("roles"),
                F.struct(F.lit("Supplier").alias("firstName"), F.col("s_name").alias("lastName")).alias("person"),
            )).alias("people"),
        ),
        {"pretty": "true"},
    )
    folder = _one_file_per_row(suppliers.select(document), shared_folder(spark, "documents"))
    rows = flatten.flatten_documents(read_documents(spark, folder, ".txt"))
    return rows.select("person_pos", "role_pos", *MISSION_COLUMNS)


@_query
def mission_index(spark, sf):
    return flatten.index_entries(b.link_index(spark, sf))


@_query
def mission_index_first(spark, sf):
    return flatten.index_entries(b.link_index(spark, sf), first=3)


@_query
def index_from_files(spark, sf):
    suppliers = b.table(spark, sf, "supplier")
    root = "https://example.com/api/supplier/"
    entries = F.array(
        F.struct(F.concat(F.lit(root), F.replace("s_name", F.lit("#"), F.lit("%23"))).alias("mission")),
        F.struct(F.concat(F.lit(root), F.col("s_nationkey").cast("string")).alias("mission")),
    )
    document = F.to_json(F.struct(entries.alias("data")), {"pretty": "true"})
    folder = _one_file_per_row(suppliers.select(document), shared_folder(spark, "index"))
    return flatten.index_entries(read_index(spark, folder))


# --- missions ------------------------------------------------------------------------


def _people(spark, sf):
    return missions.curated(missions.clean(b.mission_rows(spark, sf)))


@_query
def missions_clean(spark, sf):
    return missions.clean(b.mission_rows(spark, sf))


@_query
def missions_clean_trimmed(spark, sf):
    return missions.clean(b.mission_rows(spark, sf), trim_names=True)


@_query
def missions_curated(spark, sf):
    return _people(spark, sf)


@_query
def missions_quality_flags(spark, sf):
    return missions.quality_flags(_people(spark, sf))


@_query
def missions_by_institution(spark, sf):
    return missions.rows_by_institution(_people(spark, sf))


@_query
def missions_by_role(spark, sf):
    return missions.rows_by_role(_people(spark, sf))


@_query
def missions_kpis(spark, sf):
    return missions.headline_numbers(_people(spark, sf))


@_query
def missions_quality_summary(spark, sf):
    return missions.quality_summary(missions.quality_flags(_people(spark, sf)))


@_query
def missions_preview(spark, sf):
    return missions.preview(_people(spark, sf))


# --- files and tables ----------------------------------------------------------------


def _land_csv(df: DataFrame, folder: str, name: str) -> None:
    write_csv(df.select(*RETAIL_COLUMNS[name]), f"{folder}/{name}")


def _land_numbered_csv(df: DataFrame, key: str, folder: str, files: int = 12, first: int = 0) -> None:
    """CSV files 000.csv, 001.csv, ... by the remainder of a key, or from another first number on."""
    number = F.lpad((F.col(key).cast("bigint") % files + first).cast("string"), 3, "0")
    numbered = df.withColumn("number", number).repartition(files, "number")
    write_csv(numbered, f"{folder}/by-number-{first}", partition_by=["number"])
    move_single_files(df.sparkSession, f"{folder}/by-number-{first}", "number=", f"{folder}/named", ".csv")


@_query
def bronze_csv_roundtrip(spark, sf):
    folder, schema = _scratch(spark, "bronze")
    _land_csv(b.raw_sales(spark, sf), folder, "sales")
    run = RetailRun(landing=folder, bronze=schema)
    bronze.ingest_export(spark, run, "sales")
    return read_table(spark, run.table("bronze", "sales")).drop(INGEST_TS)


@_query
def bronze_appended_twice(spark, sf):
    folder, schema = _scratch(spark, "bronze")
    _land_csv(b.raw_orders(spark, sf), folder, "orders")
    run = RetailRun(landing=folder, bronze=schema, infer_schema=True)
    for _ in range(2):
        bronze.ingest_export(spark, run, "orders")
    return quality.status_profile(read_table(spark, run.table("bronze", "orders")))


@_query
def bronze_preview(spark, sf):
    _, schema = _scratch(spark, "bronze")
    append_table(b.raw_sales(spark, sf), f"{schema}.sales")
    preview = bronze.preview(spark, f"{schema}.sales")
    found = preview.intersect(read_table(spark, f"{schema}.sales"))
    return preview.agg(F.count("*").alias("preview_rows")).join(found.agg(F.count("*").alias("found")))


@_query
def csv_to_parquet(spark, sf):
    folder = shared_folder(spark, "convert")
    _land_numbered_csv(b.raw_orders(spark, sf).select(*RETAIL_COLUMNS["orders"]), "order_id", folder)
    convert_csv(spark, f"{folder}/named", f"{folder}/parquet")
    return read_parquet(spark, f"{folder}/parquet")


@_query
def csv_shapes_to_parquet(spark, sf):
    folder = shared_folder(spark, "convert")
    orders = b.raw_orders(spark, sf)
    _land_numbered_csv(orders.select(*RETAIL_COLUMNS["orders"]), "order_id", folder)
    _land_numbered_csv(orders.select("order_date", "order_id"), "order_id", folder, first=12)
    written = convert_each_csv(spark, f"{folder}/named", f"{folder}/parquet")
    whole, dated = spark.read.parquet(*written[:12]), spark.read.parquet(*written[12:])
    return whole.unionByName(dated, allowMissingColumns=True)


@_query
def parquet_export(spark, sf):
    folder, schema = _scratch(spark, "export")
    replace_table(b.products(spark, sf), f"{schema}.products")
    export_parquet(read_table(spark, f"{schema}.products"), f"{folder}/export")
    return files_as_table(spark, f"{folder}/export")


@_query
def path_append(spark, sf):
    path = shared_folder(spark, "append")
    for mode in ("append", "overwrite", "append"):
        write_path(b.products(spark, sf), path, mode)
    return read_parquet(spark, path)


@_query
def flat_csv_roundtrip(spark, sf):
    path = shared_folder(spark, "flat-csv")
    rows = flatten.flatten_documents(b.mission_documents(spark, sf)).withColumns({
        "institution": F.concat(F.lit("  "), "institution", F.lit("\t")), "role": F.concat(F.lit(" "), "role", F.lit(" ")),
    })
    write_flat_csv(rows, path)
    return read_flat_csv(spark, path)


@_query
def documents_csv(spark, sf):
    """Texts with line breaks, commas and quotes, read back by the splits of their files."""
    path = shared_folder(spark, "split-csv")
    docs = b.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    write_csv(docs, path)
    return read_split_csv(spark, path, docs.schema)


@_query
def flat_parquet_roundtrip(spark, sf):
    path = shared_folder(spark, "flat-parquet")
    write_flat_parquet(flatten.flatten_documents(b.mission_documents(spark, sf)), path)
    return read_parquet(spark, path)


@_query
def external_table(spark, sf):
    folder, schema = _scratch(spark, "external")
    write_flat_parquet(b.mission_rows(spark, sf), f"{folder}/flat")
    run = MissionRun(parquet_path=f"{folder}/flat", root_path=f"{folder}/external", schema=schema)
    missions.load_missions(spark, run)
    return read_table(spark, run.quality_view)


@_query
def empty_table_like(spark, sf):
    _, schema = _scratch(spark, "empty")
    make_empty_table(spark, f"{schema}.customers", f"{sf}/customer.parquet")
    return read_table(spark, f"{schema}.customers")


@_query
def clustered_rewrite(spark, sf):
    _, schema = _scratch(spark, "cluster")
    append_table(b.mission_rows(spark, sf), f"{schema}.people")
    missions.cluster_missions(spark, f"{schema}.people")
    return read_table(spark, f"{schema}.people")


@_query
def zordered_rewrite(spark, sf):
    """Lines along the curve of their keys: rows, and those of one supplier, found by its own column alone."""
    _, schema = _scratch(spark, "curve")
    append_table(b.table(spark, sf, "lineitem"), f"{schema}.lines")
    zorder_table(spark, f"{schema}.lines", ("l_orderkey", "l_suppkey"), partitions=16)
    return read_table(spark, f"{schema}.lines").where(F.col("l_suppkey") % 3 == 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("double").alias("l_quantity")
    )


@_query
def clustered_external(spark, sf):
    """Load, cluster, load again: both loads are there."""
    folder, schema = _scratch(spark, "cluster")
    write_flat_parquet(b.mission_rows(spark, sf), f"{folder}/flat")
    for mode in ("overwrite", "append"):
        run = MissionRun(parquet_path=f"{folder}/flat", root_path=f"{folder}/external", schema=schema, mode=mode)
        missions.load_missions(spark, run)
        if mode == "overwrite":
            missions.cluster_missions(spark, run.full_table)
    return read_table(spark, run.full_table)


# --- streams -------------------------------------------------------------------------


def _timed_events(spark: SparkSession, schema: str) -> DataFrame:
    return _as_text(read_table(spark, f"{schema}.events"), "ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _land_events(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """Events in one folder per day, as they would arrive over time."""
    events = b.table(spark, sf, "events")
    days = events.withColumn("day", F.col("ts").cast("date"))
    # in range order of day and event, so that a busy day is written by several tasks
    days.repartitionByRange("day", "event_id").write.partitionBy("day").parquet(f"{folder}/landing")
    return events


@_query
def stream_ingest(spark, sf):
    folder, schema = _scratch(spark, "stream")
    events = _land_events(spark, sf, folder)
    target = f"{schema}.events"
    for _ in range(2):
        ingest_available(
            spark, f"{folder}/landing", events.schema, target, f"{folder}/ledger", max_files=7, recursive=True
        )
    return _timed_events(spark, schema).drop("ingest_ts")


@_query
def stream_flatten(spark, sf):
    folder, schema = _scratch(spark, "stream")
    documents = b.mission_documents(spark, sf)
    export_parquet(documents, f"{folder}/landing")
    arriving = arriving_files(spark, f"{folder}/landing", documents.schema)
    drain_into(flatten.flatten_documents(arriving), f"{schema}.people", f"{folder}/ledger")
    return read_table(spark, f"{schema}.people")


@_query
def stream_continuous(spark, sf):
    folder, schema = _scratch(spark, "stream")
    events = _land_events(spark, sf, folder)
    files = arriving_files(spark, f"{folder}/landing", events.schema, max_files=7, recursive=True)
    running = run_into(files, f"{schema}.events", f"{folder}/ledger", interval="0 seconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _timed_events(spark, schema)


@_query
def clustered_stream(spark, sf):
    """Stream, cluster, stream more: every event is there once."""
    folder, schema = _scratch(spark, "stream")
    events = b.table(spark, sf, "events")
    for rest in (0, 1):
        events.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{folder}/landing")
        drain_into(arriving_files(spark, f"{folder}/landing", events.schema), f"{schema}.events", f"{folder}/ledger")
        if not rest:
            cluster_table(spark, f"{schema}.events", ("event_id",))
    return _timed_events(spark, schema)


@_query
def stream_changing_shapes(spark, sf):
    """Files of three shapes, in two runs: another type, a new column, missing ones; what does not fit is rescued."""
    folder, schema = _scratch(spark, "shapes")
    events = b.table(spark, sf, "events")
    part = F.col("event_id") % 3
    odd = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string")))
    shapes = [
        events.where(part == 0),
        events.where(part == 1).withColumn("user_id", F.coalesce(odd, F.col("user_id").cast("string"))),
        events.where(part == 2).select("event_id", "user_id", F.lit("late").alias("note")),
    ]
    for run in (shapes[:1], shapes[1:]):
        for i, shape in enumerate(run):
            shape.write.mode("append").parquet(f"{folder}/landing/{len(run)}-{i}")
        for _ in range(2):
            ingest_shapes(spark, f"{folder}/landing", f"{schema}.events")
    rescued = F.get_json_object("_rescued", "$.user_id")
    return _timed_events(spark, schema).drop("ingest_ts").withColumn("_rescued", rescued)


@_query
def shared_target(spark, sf):
    """Batch rows, a stream, loads and clustering of one table: a third of the events each way, twice tried, once there."""
    folder, schema = _scratch(spark, "shared")
    events, target = b.table(spark, sf, "events"), f"{schema}.events"
    part = F.col("event_id") % 4
    append_table(events.where(part == 0), target)
    for way in (1, 2, 3):
        export_parquet(events.where(part == way), f"{folder}/landing-{way}")
    for _ in range(2):
        drain_into(arriving_files(spark, f"{folder}/landing-1", events.schema), target, f"{folder}/ledger")
        load_new_files(spark, f"{folder}/landing-2", target, max_files=2)
        zorder_table(spark, target, ("user_id", "ts"))
    # the folder as a whole holds two files' worth of rows that came another way
    load_new_files(spark, f"{folder}/landing-[23]", target)
    return _timed_events(spark, schema)


@_query
def bulk_load_idempotent(spark, sf):
    folder, schema = _scratch(spark, "bulk")
    export_parquet(b.table(spark, sf, "events"), f"{folder}/landing")
    make_empty_table(spark, f"{schema}.events", f"{folder}/landing")
    for _ in range(2):
        bulk_load(spark, f"{folder}/landing", f"{schema}.events", f"{folder}/ledger")
    return _timed_events(spark, schema)


# --- all layers ----------------------------------------------------------------------


def _layers(spark: SparkSession, sf: str) -> RetailRun:
    folder, schema = _scratch(spark, "layers")
    for name, rows in b.raw_tables(spark, sf).items():
        _land_csv(rows, f"{folder}/landing", name)
    create_schema(spark, f"{schema}_silver", f"{folder}/silver")
    create_schema(spark, f"{schema}_gold", f"{folder}/gold")
    run = RetailRun(
        landing=f"{folder}/landing", bronze=schema, silver=f"{schema}_silver", gold=f"{schema}_gold", run_quality=True
    )
    medallion.build_layers(spark, run)
    return run


@_query
def medallion_layers(spark, sf):
    """All three marts of one run, in common columns."""
    run = _layers(spark, sf)
    none = F.lit(None)
    columns = {
        "daily_revenue": (F.col("order_date"), none, "total_revenue", "line_count", "order_count", "unique_customers"),
        "top_products": (
            F.col("product_id"), F.concat_ws("|", "product_name", "category"), "total_sales", "total_qty", none, none,
        ),
        "customer_360": (
            F.col("customer_id"), F.concat_ws("|", "first_name", "last_name", "email", "country"), "lifetime_spend",
            none, "lifetime_orders", none,
        ),
    }
    names = {"key": "string", "label": "string", "amount": "double", "n": "bigint", "orders": "bigint", "customers": "bigint"}
    return union_labelled([
        read_table(spark, run.table("gold", mart)).select(
            F.lit(mart).alias("mart"),
            *((F.col(c) if isinstance(c, str) else c).cast(kind).alias(name) for c, (name, kind) in zip(of, names.items())),
        )
        for mart, of in columns.items()
    ])


@_query
def medallion_results(spark, sf):
    results = read_table(spark, _layers(spark, sf).results_table)
    return quality.latest_results(results).drop("check_ts")
