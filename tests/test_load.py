import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lauter.operators.lookup import find_orphans
from lauter.plans import analytics, catalog, inputs, load
from lauter.plans.load import (
    RunResult,
    load_order_file,
    load_product_feed,
    profile_after_load,
    run_entity,
)
from lauter.schemas import FOREIGN_KEYS, TABLES
from lauter.sinks import Warehouse, paths
from lauter.sinks.dead_letters import write_dead_letters
from lauter.sources import read_csv, read_json, read_ndjson

ORDER_FILE = """\
order_id,customer_email,customer_name,customer_phone,status,total_amount,ordered_at,product_sku,quantity,unit_price,category
1,ada@example.com,Ada Abel,+1-555-0101,completed,20.00,2024-01-15 09:23:00,PEN-1,2,10.00,Office
2,ben@example.com,Ben Berg,,pending,5.50,2024-01-16 14:05:00,CUP-2,1,5.50,kitchen
3,ADA@example.com,Ada A.,+1-555-0101,completed,7.25,17/01/2024,CUP-2,1,7.25,Kitchen
4,dan@example.com,Dan Dietz,N/A,cancelled,0.00,2024-01-19 16:45:00,CUP-2,0,5.50,Kitchen
5,,No Address,,pending,9.00,2024-01-20 10:00:00,PEN-1,1,9.00,Office
6,eve@example.com,Eve Evans,null,pending,9.00,2024-01-22 09:10:00,MISSING,1,9.00,N/A
7,bad-address,Finn Faber,,pending,9.00,2024-01-22 09:10:00,PEN-1,1,9.00,Office
"""
PRODUCTS = """[
  {"sku": "pen-1", "name": "Pen", "category": "office", "price": "10.00"},
  {"sku": "CUP-2", "name": "Cup", "category": "Kitchen", "price": 5.5},
  {"sku": "PEN-1", "name": "Pen again", "category": "Office", "price": "11.00"},
  {"sku": "", "name": "Nothing", "category": "Misc", "price": "1.00"},
  {"sku": "X-1", "name": "Free", "category": "Misc", "price": "free"}
]"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "orders.csv").write_text(ORDER_FILE)
    (tmp_path / "products.json").write_text(PRODUCTS)
    return tmp_path


def values(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def letters(spark, result):
    return [json.loads(r.value) for r in spark.read.text(f"{result.dead_letter_path}/*").collect()]


def test_order_file_and_product_feed(spark, warehouse, files):
    feed = load_product_feed(warehouse, read_json(spark, str(files / "products.json")))
    assert (feed.rows_ingested, feed.rows_failed, feed.rows_duplicate) == (5, 2, 2)
    result = load_order_file(
        warehouse, read_csv(spark, str(files / "orders.csv")), source="orders.csv", with_items=True
    )
    # 2 categories, 4 customers, 5 orders, 3 items; the category N/A, a bad address as
    # customer and as order, and 4 items fail
    assert result.rows_ingested == 2 + 4 + 5 + 3
    assert values(warehouse.table("categories"), "name") == [("Kitchen",), ("Misc",), ("Office",)]
    assert values(warehouse.table("customers"), "email", "name", F.coalesce("phone", F.lit("-"))) == [
        ("ada@example.com", "Ada Abel", "+1-555-0101"),
        ("ben@example.com", "Ben Berg", "-"),
        ("dan@example.com", "Dan Dietz", "-"),
        ("eve@example.com", "Eve Evans", "-"),
    ]
    orders = warehouse.table("orders")
    assert orders.count() == 5
    assert orders.agg(F.sum("total_amount")).first()[0] == Decimal("41.75")
    assert values(warehouse.table("order_items"), "quantity", "unit_price") == [
        (1, Decimal("5.50")),
        (1, Decimal("7.25")),
        (2, Decimal("10.00")),
    ]
    found = letters(spark, result)
    reasons = sorted(entry["reason"] for entry in found)
    assert reasons == sorted(
        [
            "category validation: name: missing",
            "customer validation: email: invalid",
            "Unknown customer email: bad-address",
            "order item validation: quantity: below 1",
            "order item validation: order_index: missing",
            "order item validation: order_index: missing",
            "Unknown product sku: MISSING",
        ]
    )
    assert result.rows_failed == len(reasons)
    assert {"ts", "run_id", "reason", "record"} == set(found[0])
    [bad] = [e for e in found if e["reason"].startswith("customer")]
    assert bad["record"]["email"] == "bad-address"

    tables = {name: warehouse.table(name) for name in TABLES}
    for child, key, parent in FOREIGN_KEYS:
        assert find_orphans(tables[child], key, tables[parent]).count() == 0
    revenue = analytics.revenue_by_category(
        tables["order_items"], tables["products"], tables["categories"], tables["orders"]
    )
    assert [tuple(r) for r in revenue.collect()] == [
        ("Office", 1, 2, Decimal("20.00")),
        ("Kitchen", 1, 1, Decimal("7.25")),
    ]
    profile = profile_after_load(warehouse, "customers", 4).collect()
    assert [(r.column, r.null_count, r.reconciliation_ok) for r in profile if r.column == "phone"] == [
        ("phone", 3, True)
    ]


def test_order_file_deletes_what_no_later_step_reads(spark, warehouse, files, monkeypatch):
    load_product_feed(warehouse, read_json(spark, str(files / "products.json")))
    staged = {}

    def write(rows, folder, run_id, batch):
        entity = batch.partition("-")[2]
        top = warehouse.path("_staging", f"{run_id}-0")
        staged[entity] = {n: set(paths.names(spark, f"{top}/{n}")) for n in paths.names(spark, top)}
        return write_dead_letters(rows, folder, run_id, batch)

    monkeypatch.setattr(load, "write_dead_letters", write)
    raw = read_csv(spark, str(files / "orders.csv"))
    result = load_order_file(warehouse, raw, with_items=True)
    assert result.rows_ingested == 2 + 4 + 5 + 3
    assert set(staged["customers"]) == {"raw", "customers"}
    assert set(staged["orders"]) == {"raw", "orders"}
    assert {n for n in staged["orders"]["raw"] if "=" in n} == {"_blank=true"}
    assert set(staged["order_items"]) == {"order_items"}


def test_order_file_without_blank_or_known_buyers(spark, warehouse):
    row = "SELECT {} customer_email, 'Ada' customer_name, '' customer_phone, 'shipped' status, " \
        "'5' total_amount, '2024-01-01' ordered_at, 'X' product_sku, '1' quantity, '1' unit_price, " \
        "'Books' category, 1 _pos"
    run_entity(warehouse, spark.sql("SELECT 'X' sku, 'x' name, '1' price, 1 _pos"), "products")
    nobody = load_order_file(
        warehouse, spark.sql(row.format("''") + " UNION ALL " + row.format("NULL")), with_items=True
    )
    assert (nobody.rows_ingested, nobody.rows_failed) == (1, 2)
    nothing = load_order_file(warehouse, spark.sql(row.format("'a@b.co'")).where("false"), with_items=True)
    assert (nothing.rows_ingested, nothing.rows_failed) == (0, 0)
    buyer = load_order_file(warehouse, spark.sql(row.format("'a@b.co'")), with_items=True)
    assert (buyer.rows_ingested, buyer.rows_failed) == (4, 0)


def test_dead_letters_take_less_room_than_their_lines(spark, warehouse):
    rows = spark.range(20_000).selectExpr("id AS i", "'Ada' AS name", "concat('no-address-', id) AS email")
    result = run_entity(warehouse, rows, "customers", order_by=["i"])
    found = letters(spark, result)
    assert len(found) == result.rows_failed == 20_000
    assert {e["record"]["email"] for e in found} == {f"no-address-{i}" for i in range(20_000)}
    written = sum(len(json.dumps(e)) for e in found)
    assert paths.size(spark, result.dead_letter_path) * 5 < written


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = disk.getAllFiles().iterator()
    names = set()
    while found.hasNext():
        name = found.next().getName()
        if name.startswith("shuffle_"):
            names.add(name)
    return names


def test_load_leaves_no_shuffle_files(spark, warehouse):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), shuffle_files(spark)
    rows = spark.range(5_000).selectExpr("id AS i", "'Ada' AS name", "concat('u', id % 700, '@b.co') AS email")
    assert run_entity(warehouse, rows.repartition(5, "email"), "customers", order_by=["i"]).rows_ingested == 700
    broken = rows.repartition(6, "email").withColumn("name", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        run_entity(warehouse, broken, "customers", order_by=["i"])
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_order_lines_are_those_of_the_text(spark, tmp_path, broadcast):
    """Odd keys and lines that come twice; a line is shuffled once, if its orders are not broadcast."""
    spark.sql(
        "SELECT CAST(k AS BIGINT) o_orderkey, CAST(c AS BIGINT) o_custkey, 'F' o_orderstatus, "
        "12.5D o_totalprice, timestamp'1996-01-02' o_orderdate, '1' o_orderpriority "
        "FROM VALUES (1, 1), (2, 2), (2, 1), (3, NULL), (NULL, 1), (41, 1), (-7, 2) t(k, c)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT CAST(k AS BIGINT) c_custkey, n c_name FROM VALUES (1, 'Ada'), (2, 'Ben'), (2, 'Ben II'), "
        "(NULL, 'Eve'), (9, NULL) t(k, n)"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql(
        "SELECT CAST(k AS BIGINT) l_orderkey, CAST(n AS BIGINT) l_partkey, n l_linenumber, 2D l_quantity, "
        "n * 10D l_extendedprice FROM VALUES (1, 1), (1, 2), (1, 2), (2, 1), (2, 3), (3, 1), (NULL, 1), "
        "(5, 1), (41, 4), (-7, 1), (1, NULL) t(k, n)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, broadcast)
    try:
        text = inputs.derive(spark, str(tmp_path), catalog.ORDER_FILE)
        lines = catalog.order_lines(spark, str(tmp_path))
        assert lines.schema == text.schema
        # which of two lines that are alike in all but the buyer's name comes first is open
        shown = [F.floor(F.col("n") / 1000).alias("n"), *[c for c in text.columns if c != "n"]]
        assert sorted(map(str, lines.select(*shown).collect())) == sorted(map(str, text.select(*shown).collect()))
        assert sorted(r.n for r in lines.collect()) == sorted(r.n for r in text.collect()) != []
        plans = [f.select("*")._jdf.queryExecution().executedPlan().toString() for f in (text, lines)]
    finally:
        spark.conf.set(name, before)
    if broadcast == "-1":
        # lines, orders, orders again, customers and the buyers of orders
        assert [p.count("Exchange hashpartitioning") for p in plans] == [7, 5]


def test_run_entity_routes(spark, warehouse, files):
    raw = read_csv(spark, str(files / "orders.csv"))
    wrong = run_entity(warehouse, raw, "customers")
    assert (wrong.rows_ingested, wrong.rows_failed) == (0, 7)
    none_known = run_entity(warehouse, raw, "orders")
    assert (none_known.rows_ingested, none_known.rows_failed) == (0, 7)
    assert none_known.error_log == (
        "Unknown customer email (x6)\norder validation: customer_email: missing"
    )
    generic = run_entity(warehouse, raw)
    assert (generic.rows_ingested, generic.rows_failed, generic.dead_letter_path) == (0, 0, None)
    runs = warehouse.table("pipeline_runs").orderBy("id").collect()
    assert [(r.id, r.source, r.rows_failed) for r in runs] == [
        (1, "customers", 7),
        (2, "orders", 7),
        (3, "generic", 0),
    ]
    assert all(r.finished_at >= r.started_at for r in runs)
    assert runs[2].error_log is None


def test_json_source_and_single_category_run(spark, warehouse, tmp_path):
    path = tmp_path / "c.ndjson"
    path.write_text('{"name": "books"}\nBROKEN\n{"name": "BOOKS"}\n{"name": 7}\n')
    result = run_entity(warehouse, read_ndjson(spark, str(path)), "categories")
    assert (result.rows_ingested, result.rows_failed, result.rows_duplicate) == (1, 1, 1)
    assert letters(spark, result)[0]["record"] == {"name": 7}


def customers(spark, *rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, name string, email string, phone string"
    )


def test_upsert_keeps_identity(spark, warehouse):
    run_entity(
        warehouse,
        customers(spark, ("Ada", "a@b.co", "+1-555-0101"), ("Ben", "b@b.co", None)),
        "customers",
        order_by=["i"],
    )
    before = {r.email: r for r in warehouse.table("customers").collect()}
    result = run_entity(
        warehouse,
        customers(spark, ("Adele", "A@B.co", None), ("Cleo", "c@b.co", None)),
        "customers",
        order_by=["i"],
    )
    after = {r.email: r for r in warehouse.table("customers").collect()}
    assert result.rows_ingested == 2
    assert set(after) == {"a@b.co", "b@b.co", "c@b.co"}
    assert after["b@b.co"] == before["b@b.co"]
    assert (after["a@b.co"].id, after["a@b.co"].created_at) == (before["a@b.co"].id, before["a@b.co"].created_at)
    assert (after["a@b.co"].name, after["a@b.co"].phone) == ("Adele", None)
    assert len({r.id for r in after.values()}) == 3


def test_category_parent_survives_an_upsert(spark, warehouse):
    rows = spark.createDataFrame([(1, "Books", None), (2, "Novels", 1)], "id bigint, name string, parent_id bigint")
    warehouse.reserve_ids("categories", 2)
    warehouse.upsert("categories", rows)
    novels = spark.createDataFrame([("novels",)], "name string")
    with pytest.raises(ValueError, match="order"):
        run_entity(warehouse, novels, "categories")
    run_entity(warehouse, novels, "categories", order_by=["name"])
    assert values(warehouse.table("categories"), "name", F.coalesce("parent_id", F.lit(0))) == [
        ("Books", 0),
        ("Novels", 1),
    ]


def test_unfinished_load_is_not_read(spark, warehouse):
    run_entity(warehouse, customers(spark, ("Ada", "a@b.co", None)), "customers", order_by=["i"])
    half = warehouse.path("customers", "half-written", "_bucket=0")
    warehouse.table("customers").limit(1).write.parquet(half)
    assert warehouse.table("customers").count() == 1
    run_entity(warehouse, customers(spark, ("Ben", "b@b.co", None)), "customers", order_by=["i"])
    assert warehouse.table("customers").count() == 2
    assert warehouse.keyed("customers").vacuum() == ["half-written"]
    assert warehouse.table("customers").count() == 2


def test_replayed_load_replaces_its_rows(spark, warehouse):
    run_entity(warehouse, customers(spark, ("Ada", "a@b.co", None)), "customers", order_by=["i"])
    order = spark.sql("SELECT 'a@b.co' customer_email, '5' total_amount, '2024-01-01' ordered_at, 'x' status")
    for _ in range(2):
        run_entity(warehouse, order, "orders", run_id="same")
    assert warehouse.table("orders").count() == 1
    run_entity(warehouse, order, "orders")
    assert warehouse.table("orders").count() == 2
    assert warehouse.table("orders").select("id").distinct().count() == 2


def test_failed_run_is_audited(spark, warehouse):
    broken = spark.sql("SELECT raise_error('boom') name, 'a@b.co' email")
    with pytest.raises(Exception, match="boom"):
        run_entity(warehouse, broken, "customers", source="broken", order_by=["email"])
    [run] = warehouse.table("pipeline_runs").collect()
    assert run.source == "broken" and "boom" in run.error_log
    assert warehouse.table("customers").count() == 0


def test_views(spark, warehouse):
    run_entity(warehouse, customers(spark, ("Ada", "a@b.co", None)), "customers", order_by=["i"])
    orders = spark.sql(
        "SELECT 'a@b.co' customer_email, s status, '5' total_amount, '2024-01-01' ordered_at "
        "FROM VALUES ('pending'), ('shipped') t(s)"
    )
    run_entity(warehouse, orders, "orders")
    warehouse.create_views("w_")
    assert spark.sql("SELECT status FROM w_pending_orders").collect()[0].status == "pending"
    assert spark.sql("SELECT count(*) c FROM w_pending_orders").first().c == 1


def test_create_keeps_existing_tables(spark, warehouse):
    run_entity(warehouse, customers(spark, ("Ada", "a@b.co", None)), "customers", order_by=["i"])
    again = Warehouse(spark, warehouse.root).create()
    assert again.table("customers").count() == 1


def test_summary():
    result = RunResult("f.csv", "12345678-abc", started_at=datetime(2024, 1, 1))
    assert result.summary() == "run 12345678 of f.csv [in progress]"
    result.finished_at = datetime(2024, 1, 1, 0, 0, 2, 500000)
    result.rows_ingested, result.rows_failed, result.chunks_processed = 3, 1, 1
    assert result.summary() == "run 12345678 of f.csv: 3 loaded, 1 rejected, 0 repeated, 0 skipped, 1 chunks, 2.50s"
