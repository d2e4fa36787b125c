"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lauter.functions import coerce, text
from lauter.operators import dedup, lookup, profile, report
from lauter.operators.cleaning import clean
from lauter.operators.rules import ENTITIES, ERRORS, accepted, classify, reason, rejected
from lauter.plans import analytics, inputs
from lauter.plans.load import (
    load_order_file,
    load_product_feed,
    profile_after_load,
    reject_reasons,
    run_entity,
)
from lauter.session import configure, scratch_path
from lauter.sinks import Warehouse, dead_letter_rows
from lauter.sources import (
    flatten_pages,
    parse_lines,
    read_csv,
    read_csv_split,
    read_json,
    read_json_split,
    read_ndjson,
    read_parquet,
)
from lauter.sources.json_records import VARIANT, parse_documents
from lauter.streaming import stream_entity, stream_ndjson, stream_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# bind parameters
CUSTOMER_ID = 7
RUN_ID = 808785
PENDING_FROM, PENDING_TO = datetime(1996, 1, 1), datetime(1998, 6, 30)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _given(spark: SparkSession, folder: str, *texts: str) -> list[DataFrame]:
    configure(spark)
    return [inputs.derive(spark, folder, sql) for sql in texts]


# -- analytics ---------------------------------------------------------------


@query
def q1_customer_history(spark: SparkSession, folder: str) -> DataFrame:
    [orders] = _given(spark, folder, inputs.ORDERS)
    return analytics.customer_history(orders, CUSTOMER_ID)


@query
def q2_pending_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = _given(spark, folder, inputs.ORDERS, inputs.CUSTOMERS)
    return analytics.pending_dashboard(orders, customers, PENDING_FROM, PENDING_TO)


@query
def pending_orders_view(spark: SparkSession, folder: str) -> DataFrame:
    [orders] = _given(spark, folder, inputs.ORDERS)
    return analytics.pending_orders(orders)


@query
def q3_revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    items, products, categories, orders = _given(
        spark, folder, inputs.ORDER_ITEMS, inputs.PRODUCTS, inputs.CATEGORIES, inputs.ORDERS
    )
    return analytics.revenue_by_category(items, products, categories, orders).withColumn(
        "revenue", F.col("revenue").cast("decimal(38,2)")
    )


@query
def q4_daily_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    return analytics.daily_run_summary(runs)


@query
def q5_top_products(spark: SparkSession, folder: str) -> DataFrame:
    items, products = _given(spark, folder, inputs.ORDER_ITEMS, inputs.PRODUCTS)
    return analytics.top_products(items, products).withColumn(
        "revenue", F.col("revenue").cast("decimal(38,2)")
    )


# -- cleaning ----------------------------------------------------------------

# the texts the cleaning queries start from
DECOMPOSED = "CASE WHEN doc_id % 2 = 0 THEN replace(text, '\u00e9', 'e\u0301') ELSE text END"
WITH_CONTROLS = "concat(' \t', replace(text, ' ', ' \x01‍\x7f'), ' \n　')"
SENTINEL = (
    "CASE doc_id % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN 'NULL' WHEN 2 THEN 'none' WHEN 3 THEN '--' "
    "WHEN 4 THEN 'Undefined' WHEN 5 THEN '' WHEN 6 THEN lang ELSE source END"
)


def _documents(spark: SparkSession, folder: str, expression: str) -> DataFrame:
    configure(spark)
    return inputs.table(spark, folder, "documents").selectExpr("doc_id", f"{expression} AS text")


def _digest(df: DataFrame, *columns: str) -> DataFrame:
    """Whole texts compared by length and hash."""
    parts = []
    for c in columns:
        parts += [
            F.length(c).cast("bigint").alias(f"{c}_length"),
            F.md5(F.col(c)).alias(f"{c}_md5"),
        ]
    return df.select("doc_id", *parts)


@query
def clean_nfc(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder, DECOMPOSED)
    return _digest(docs.withColumn("text", text.fix_encoding(F.col("text"))), "text")


@query
def clean_strip_control(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder, WITH_CONTROLS)
    return _digest(docs.withColumn("text", text.strip(text.fix_encoding(F.col("text")))), "text")


@query
def clean_nulls(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    docs = inputs.table(spark, folder, "documents").selectExpr("doc_id", "text", f"{SENTINEL} AS mark")
    columns = ["text", "mark"]
    return _digest(docs.withColumns({c: text.nullify(F.col(c)) for c in columns}), *columns)


@query
def clean_truncate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder, "text")
    names = [*text.MAX_LENGTHS, "other"]
    cut = docs.select("doc_id", *[text.truncate(F.col("text"), n).alias(n) for n in names])
    return _digest(cut, *names)


@query
def clean_records(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_CUSTOMERS)
    return clean(raw)


# -- validation --------------------------------------------------------------

RAW = {
    "customers": inputs.RAW_CUSTOMERS,
    "categories": inputs.RAW_CATEGORIES,
    "products": inputs.RAW_PRODUCTS,
    "orders": inputs.RAW_ORDERS,
    "order_items": inputs.RAW_ITEMS,
}


def _classified(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    [raw] = _given(spark, folder, RAW[entity])
    if entity == "order_items":
        return classify(raw, entity, keep=["line"])
    return classify(raw, entity, order_by=["pos"], keep=["pos"])


def _judged(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    rows = _classified(spark, folder, entity)
    shown = [*ENTITIES[entity].field_names, "line" if entity == "order_items" else "pos"]
    return rows.select(*shown, F.col(ERRORS).alias("errors"))


@query
def validate_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder, "customers")


@query
def validate_categories(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder, "categories")


@query
def validate_products(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder, "products")


@query
def validate_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder, "orders")


@query
def validate_items(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder, "order_items")


@query
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_ORDERS)
    return raw.select(
        "pos", "ordered_at", coerce.to_timestamp(F.col("ordered_at")).alias("parsed")
    )


@query
def price_half_even(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_ITEMS)
    price = coerce.to_price(F.col("unit_price")).cast("decimal(20,2)")
    return raw.select("order_index", "line", "unit_price", price.alias("price"))


@query
def title_case(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_CATEGORIES)
    return raw.select("pos", text.title_case(F.col("name")).alias("name"))


@query
def reject_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = [
        report.reason_counts(rejected(_classified(spark, folder, e)), reason(e)) for e in RAW
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3]).unionAll(counts[4])


# -- deduplication -----------------------------------------------------------


def _first(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    rows = dedup.first_valid(_classified(spark, folder, entity), entity)
    return rows.select(F.col("pos").alias("id"), *ENTITIES[entity].field_names)


@query
def dedup_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _first(spark, folder, "customers")


@query
def dedup_categories(spark: SparkSession, folder: str) -> DataFrame:
    return _first(spark, folder, "categories")


@query
def dedup_products(spark: SparkSession, folder: str) -> DataFrame:
    return _first(spark, folder, "products")


@query
def distinct_categories(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_PRODUCTS)
    return dedup.distinct_values(raw, "category")


# -- lookups -----------------------------------------------------------------


def _resolved_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = _classified(spark, folder, "orders")
    return lookup.resolve_customer(orders, _first(spark, folder, "customers"))


def _resolved_items(spark: SparkSession, folder: str) -> DataFrame:
    items = _classified(spark, folder, "order_items")
    return lookup.resolve_product(items, _first(spark, folder, "products"))


@query
def orders_fk_accept(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(_resolved_orders(spark, folder))
    return rows.select("pos", "customer_id", "status", "total_amount", "ordered_at")


@query
def orders_fk_reject(spark: SparkSession, folder: str) -> DataFrame:
    rows = rejected(_resolved_orders(spark, folder))
    return rows.select("pos", reject_reasons("orders")[1].alias("reason"))


@query
def products_fk_left(spark: SparkSession, folder: str) -> DataFrame:
    products = dedup.first_valid(_classified(spark, folder, "products"), "products")
    rows = lookup.resolve_category(products, _first(spark, folder, "categories"))
    return rows.select("sku", "name", "category_id", "price")


@query
def items_fk_accept(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(_resolved_items(spark, folder))
    return rows.select("order_index", "line", "product_id", "quantity", "unit_price")


@query
def items_fk_reject(spark: SparkSession, folder: str) -> DataFrame:
    rows = rejected(_resolved_items(spark, folder))
    return rows.select(
        "order_index", "line", reject_reasons("order_items")[1].alias("reason")
    )


@query
def id_map(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.id_map(_first(spark, folder, "customers"), "email")


@query
def orphans(spark: SparkSession, folder: str) -> DataFrame:
    [orders] = _given(spark, folder, inputs.ORDERS)
    customers = _first(spark, folder, "customers")
    return lookup.find_orphans(orders, "customer_id", customers).select("id", "customer_id")


# -- stored tables -----------------------------------------------------------


def _warehouse(spark: SparkSession, label: str, **options) -> Warehouse:
    configure(spark)
    return Warehouse(spark, scratch_path(spark, label), **options)


@query
def upsert_customers(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "customers")
    for feed in _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.LATER_CUSTOMERS):
        run_entity(warehouse, feed, "customers", order_by=["pos"])
    return warehouse.table("customers").select("email", "name", "phone")


@query
def upsert_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same loads into small buckets: the second one writes those it touches (K2)."""
    warehouse = _warehouse(spark, "buckets", rows_per_bucket=6_400)
    for feed in _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.LATER_CUSTOMERS):
        run_entity(warehouse, feed, "customers", order_by=["pos"])
    return warehouse.table("customers").select("email", "name", "phone")


@query
def upsert_products(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "products")
    categories, *feeds = _given(
        spark, folder, inputs.RAW_CATEGORIES, inputs.RAW_PRODUCTS, inputs.LATER_PRODUCTS
    )
    run_entity(warehouse, categories, "categories", order_by=["pos"])
    for feed in feeds:
        run_entity(warehouse, feed, "products", order_by=["pos"])
    names = warehouse.table("categories").select(
        F.col("id").alias("category_id"), F.col("name").alias("category")
    )
    rows = warehouse.table("products").join(names, "category_id", "left")
    return rows.select("sku", "name", "category", "price")


@query
def upsert_categories(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "categories")
    raw, products = _given(spark, folder, inputs.RAW_CATEGORIES, inputs.RAW_PRODUCTS)
    run_entity(warehouse, raw, "categories", order_by=["pos"])
    names = dedup.distinct_values(products, "category").withColumnRenamed("category", "name")
    run_entity(warehouse, names, "categories", order_by=["name"])
    return warehouse.table("categories").select("name", "parent_id")


def _stored_orders(warehouse: Warehouse) -> DataFrame:
    customers = warehouse.table("customers").select(F.col("id").alias("customer_id"), "email")
    rows = warehouse.table("orders").join(customers, "customer_id")
    return rows.select("email", "status", "total_amount", "ordered_at")


@query
def append_orders(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "orders")
    customers, orders = _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.RAW_ORDERS)
    run_entity(warehouse, customers, "customers", order_by=["pos"])
    run_entity(warehouse, orders, "orders", order_by=["pos"])
    return _stored_orders(warehouse)


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "stream")
    customers, orders = _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.RAW_ORDERS)
    run_entity(warehouse, customers, "customers", order_by=["pos"])
    landing = warehouse.path("landing")
    orders.repartition(4).write.json(landing)
    stream = stream_ndjson(spark, landing, files_per_batch=2)
    stream_entity(
        warehouse, stream, "orders", run_id="stream", checkpoint=warehouse.path("checkpoint")
    ).awaitTermination()
    return _stored_orders(warehouse)


@query
def stream_parquet_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The orders as a stream of Parquet files, compacted on the way."""
    warehouse = _warehouse(spark, "stream")
    customers, orders = _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.RAW_ORDERS)
    run_entity(warehouse, customers, "customers", order_by=["pos"])
    landing = warehouse.path("landing")
    orders.repartition(6).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    stream_entity(
        warehouse, stream_parquet(spark, landing, schema, files_per_batch=2), "orders", run_id="stream",
        checkpoint=warehouse.path("checkpoint"), schema=schema, compact_every=2,
    ).awaitTermination()
    return _stored_orders(warehouse)


@query
def ingested_by_source_entity(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per source and entity, as the steps of the runs noted them."""
    warehouse = _warehouse(spark, "steps")
    customers, orders = _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.RAW_ORDERS)
    run_entity(warehouse, customers, "customers", source="crm", order_by=["pos"])
    run_entity(warehouse, orders, "orders", source="shop", order_by=["pos"])
    run_entity(warehouse, orders, "orders", source="shop", order_by=["pos"])
    labels = ["source", "entity", "status"]
    ingested = report.counters(warehouse.steps(), labels, "rows_ingested", "rows_ingested_total")
    return ingested.join(report.counters(warehouse.steps(), labels, "rows_failed", "rows_failed_total"), labels)


@query
def batch_duration_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Durations of batches per source, entity and status (A14): every event is a batch that
    took as many tenths of a second as its value."""
    [steps] = _given(spark, folder, inputs.STEPS)
    return report.duration_histogram(steps, ("source", "entity", "status"), report.BATCH_BUCKETS)


@query
def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "rejects")
    [raw] = _given(spark, folder, inputs.RAW_CUSTOMERS)
    result = run_entity(warehouse, raw, "customers", order_by=["pos"])
    lines = spark.read.schema("run_id string, reason string, record struct<pos: bigint>").json(
        f"{result.dead_letter_path}/*"
    )
    return lines.where(F.col("run_id") == result.run_id).select("reason", "record.pos")


@query
def run_audit(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark, "audit")
    customers, orders = _given(spark, folder, inputs.RAW_CUSTOMERS, inputs.RAW_ORDERS)
    run_entity(warehouse, customers, "customers", order_by=["pos"])
    run_entity(warehouse, orders, "orders", order_by=["pos"])
    run_entity(warehouse, orders, "generic")
    return warehouse.table("pipeline_runs").select(
        "source", "rows_ingested", "rows_failed", "error_log"
    )


# some rows without an address: they name a category and an item, but no buyer and no order
ORDER_FILE = """
SELECT o.pos * 1000 + row_number() OVER (
    PARTITION BY o.pos ORDER BY i.line, i.product_sku, i.quantity, i.unit_price) AS n,
  CASE WHEN o.pos % 37 = 0 THEN '' WHEN o.pos % 41 = 0 THEN NULL ELSE o.customer_email END
    AS customer_email, c.c_name AS customer_name,
  CASE WHEN o.pos % 5 = 0 THEN 'N/A' ELSE '+1-555-0101' END AS customer_phone,
  o.status, o.total_amount, o.ordered_at, i.product_sku, i.quantity, i.unit_price,
  CASE WHEN o.pos % 3 = 0 THEN 'electronics' WHEN o.pos % 3 = 1 THEN 'BOOKS' ELSE 'N/A' END
    AS category
FROM ({items}) i
JOIN ({orders}) o ON i.order_index = CAST(o.pos AS STRING)
JOIN {{orders}} k ON k.o_orderkey = o.pos
JOIN {{customer}} c ON c.c_custkey = k.o_custkey
""".format(items=inputs.RAW_ITEMS, orders=inputs.RAW_ORDERS)


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``ORDER_FILE``, whose text would shuffle every line four times.

    Buyers meet orders first, then lines, orders and the numbering share one key: the number
    that ``order_index`` is the text of.
    """
    items, orders = _given(spark, folder, inputs.RAW_ITEMS, inputs.RAW_ORDERS)
    buyers = inputs.derive(
        spark, folder,
        "SELECT o_orderkey, c_name FROM {orders} JOIN {customer} ON c_custkey = o_custkey",
    )
    lines = items.withColumn("order_number", F.col("order_index").try_cast("bigint"))
    lines = lines.where(F.col("order_index") == F.col("order_number").cast("string"))
    columns = ORDER_FILE.partition("FROM (")[0]
    return spark.sql(
        f"{columns} FROM {{items}} i JOIN {{orders}} o ON i.order_number = o.pos "
        "JOIN {buyers} c ON c.o_orderkey = o.pos",
        items=lines, orders=orders, buyers=buyers,
    )


@query
def order_file(spark: SparkSession, folder: str) -> DataFrame:
    """Product feed and denormalised order file (E2-E4, F5): every row of the five tables."""
    warehouse = _warehouse(spark, "order-file")
    [products] = _given(spark, folder, inputs.RAW_PRODUCTS)
    orders = order_lines(spark, folder)
    load_product_feed(warehouse, products.withColumn("_pos", F.col("pos")))
    load_order_file(warehouse, orders.withColumn("_pos", F.col("n")), with_items=True)

    names = {t: warehouse.table(t) for t in ("categories", "products", "customers", "orders", "order_items")}
    categories = names["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    buyers = names["customers"].select(F.col("id").alias("customer_id"), "email")
    names["products"] = names["products"].join(categories, "category_id", "left")
    names["orders"] = names["orders"].join(buyers, "customer_id")
    ordered = names["orders"].select(F.col("id").alias("order_id"), "email", "total_amount", "ordered_at")
    skus = names["products"].select(F.col("id").alias("product_id"), "sku")
    names["order_items"] = names["order_items"].join(ordered, "order_id").join(skus, "product_id")
    shown = {
        "categories": ["name"],
        "products": ["sku", "name", "category", "price"],
        "customers": ["email", "name", "phone"],
        "orders": ["email", "status", "total_amount", "ordered_at"],
        "order_items": ["email", "total_amount", "ordered_at", "sku", "quantity", "unit_price"],
    }
    parts = []
    for table, columns in shown.items():
        values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
        parts.append(names[table].select(F.lit(table).alias("table_name"), F.concat_ws("|", *values).alias("row")))
    return reduce(DataFrame.unionAll, parts)


# -- quality and audit -------------------------------------------------------


@query
def profile_customer(spark: SparkSession, folder: str) -> DataFrame:
    [customers] = _given(spark, folder, inputs.CUSTOMERS)
    return profile.profile_table(customers, "customers", 0)


@query
def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    [items] = _given(spark, folder, inputs.ORDER_ITEMS)
    return profile.profile_table(items, "order_items", 10**12)


@query
def profile_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Profile right after a load (E5)."""
    warehouse = _warehouse(spark, "profile")
    [raw] = _given(spark, folder, inputs.RAW_CUSTOMERS)
    result = run_entity(warehouse, raw, "customers", order_by=["pos"])
    return profile_after_load(warehouse, "customers", result.rows_ingested)


@query
def high_null_columns(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    found = profile.high_null_columns(profile.profile_table(runs, "pipeline_runs", 0))
    return found.select("column", "null_count", "null_rate")


@query
def value_distribution(spark: SparkSession, folder: str) -> DataFrame:
    [orders] = _given(spark, folder, inputs.ORDERS)
    return profile.value_distribution(orders, "status")


@query
def latest_runs(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    return report.latest_runs(runs)


@query
def runs_page(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    return report.runs_page(runs, limit=20, offset=40)


@query
def run_by_id(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    return report.run_by_id(runs, RUN_ID)


@query
def error_log(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_CUSTOMERS)
    rows = classify(raw, "customers", order_by=["pos"], keep=["segment"])
    return report.error_log(rejected(rows), reason("customers"), "segment")


@query
def ingested_by_source(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    return report.counters(runs, ["source"], "rows_ingested", "rows_ingested_total")


@query
def failed_by_category(spark: SparkSession, folder: str) -> DataFrame:
    orders = rejected(_resolved_orders(spark, folder))
    letters = dead_letter_rows(orders, "run", reject_reasons("orders")[1])
    labelled = letters.select(
        F.lit("orders").alias("source"),
        report.reason_category().alias("reason_category"),
        F.lit(1).alias("rows"),
    )
    return report.counters(labelled, ["source", "reason_category"], "rows", "rows_failed_total")


@query
def duration_histogram(spark: SparkSession, folder: str) -> DataFrame:
    [runs] = _given(spark, folder, inputs.RUNS)
    return report.duration_histogram(runs)


# -- sources -----------------------------------------------------------------


@query
def parquet_projection(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    columns = ["l_orderkey", "l_quantity", "l_shipdate"]
    return read_parquet(spark, f"{folder}/lineitem.parquet", columns).select(*columns)


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    [raw] = _given(spark, folder, inputs.RAW_CUSTOMERS)
    path = scratch_path(spark, "csv")
    writer = raw.withColumn("name", F.concat("name", F.lit('\n"quoted", lines')))
    (
        writer.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    rows = read_csv(spark, path)
    return rows.select("pos", "name", "email", F.coalesce("phone", F.lit("")).alias("phone"))


@query
def ndjson_lines(spark: SparkSession, folder: str) -> DataFrame:
    [lines] = _given(spark, folder, inputs.JSON_LINES)
    return _json_fields(parse_lines(lines), "event_id", "problem")


@query
def ndjson_records(spark: SparkSession, folder: str) -> DataFrame:
    [lines] = _given(spark, folder, inputs.JSON_LINES)
    path = scratch_path(spark, "ndjson")
    lines.select("value").write.text(path)
    return _json_fields(read_ndjson(spark, path))


def _json_fields(records: DataFrame, *others: str) -> DataFrame:
    return records.select(
        *others,
        F.try_variant_get(VARIANT, "$.id", "bigint").alias("id"),
        F.try_variant_get(VARIANT, "$.type", "string").alias("type"),
        F.try_variant_get(VARIANT, "$.props.k", "bigint").alias("k"),
    )


@query
def json_array(spark: SparkSession, folder: str) -> DataFrame:
    [documents] = _given(spark, folder, inputs.JSON_DOCUMENTS)
    rows = parse_documents(documents, "value", "event_id")
    return rows.select("event_id", F.try_variant_get(VARIANT, "$.k", "bigint").alias("k"))


def _as_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The objects of a task as the lines of one JSON array, with an item that is none."""
    yield pa.RecordBatch.from_pydict({"value": ["["]})
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"value": [f"{line}," for line in batch["value"].to_pylist()]})
    yield pa.RecordBatch.from_pydict({"value": ["null]"]})


# a document has some 27 MB at most; one task writes it
DOCUMENT_EVENTS = 250_000


def _documents_of(spark: SparkSession, folder: str, least: int) -> str:
    """The events as JSON documents, one file per task; braces and quotes within strings.

    ``least`` documents, more if they would have more than ``DOCUMENT_EVENTS`` events.
    """
    configure(spark)
    events = inputs.table(spark, folder, "events")
    tasks = max(least, -(-events.count() // DOCUMENT_EVENTS))
    events = events.repartition(tasks, "event_id")
    note = F.concat(F.lit('}"],\\{'), "event_type", F.lit("\n["), "props")
    record = F.struct("event_id", note.alias("note"), F.array(F.struct("value")).alias("seen"))
    path = scratch_path(spark, "json")
    events.select(F.to_json(record).alias("value")).mapInArrow(_as_document, "value string").write.text(path)
    return path


def _document_fields(records: DataFrame) -> DataFrame:
    return records.select(
        F.try_variant_get(VARIANT, "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get(VARIANT, "$.note", "string").alias("note"),
        F.try_variant_get(VARIANT, "$.seen[0].value", "double").alias("value"),
    )


@query
def json_files(spark: SparkSession, folder: str) -> DataFrame:
    """Document files of all events, read back as records."""
    return _document_fields(read_json(spark, _documents_of(spark, folder, 8)))


def _small_ranges(spark: SparkSession, size: int) -> SparkSession:
    """A session of its own, in which files are cut into ranges of so many bytes."""
    session = configure(spark.newSession())
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", str(size))
    return session


@query
def json_split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Two large documents of all events, or as many as they need, cut into ranges of 64 KB."""
    path = _documents_of(spark, folder, 2)
    return _document_fields(read_json_split(_small_ranges(spark, 1 << 16), path))


@query
def csv_split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, with line ends and quotes in their texts, as CSV cut into ranges."""
    configure(spark)
    docs = inputs.table(spark, folder, "documents")
    path = scratch_path(spark, "csv")
    words = F.concat(F.lit('"Q", '), "text", F.lit('\n"'))
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.select("doc_id", "lang", words.alias("text")).write.options(**options).csv(path)
    rows = read_csv_split(_small_ranges(spark, 1 << 16), path)
    return _digest(rows.withColumn("doc_id", F.col("doc_id").cast("bigint")), "lang", "text")


@query
def ndjson_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that hold no record beside the records that were rejected (S3, K3)."""
    [lines] = _given(spark, folder, inputs.JSON_LINES)
    path = scratch_path(spark, "ndjson")
    lines.select("value").write.text(path)
    result = run_entity(_warehouse(spark, "skipped"), read_ndjson(spark, path, skipped=True), "categories")
    letter = F.parse_json("value")
    kept = spark.read.text(f"{result.dead_letter_path}/*").select(
        F.variant_get(letter, "$.reason", "string").alias("reason"),
        F.try_variant_get(letter, "$.record.id", "bigint").alias("record_id"),
        F.try_variant_get(letter, "$.record", "string").alias("line"),
    )
    return kept.withColumn("line", F.when(F.col("record_id").isNull(), F.col("line")))


@query
def page_flatten(spark: SparkSession, folder: str) -> DataFrame:
    [pages] = _given(spark, folder, inputs.PAGES)
    rows = flatten_pages(pages, "payload")
    return rows.select(
        "event_id", "next_url", F.try_variant_get(VARIANT, "$.k", "bigint").alias("k")
    )
