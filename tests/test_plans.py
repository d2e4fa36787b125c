"""Physical plans and skew: what makes the operators hold on large inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lauter.operators import dedup, lookup, profile, report
from lauter.operators.rules import classify, is_accepted, rejected
from lauter.plans import analytics


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_partitions(spark):
    """Make AQE treat this test's data as it would treat large data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_of_a_lookup_is_split(spark, small_partitions):
    orders = spark.range(60_000, numPartitions=8).selectExpr(
        "id AS _pos", "if(id % 3 = 0, 'hot', concat('k', id)) AS email", "uuid() AS payload"
    )
    customers = spark.range(60_000).selectExpr("if(id = 0, 'hot', concat('k', id)) AS email", "id")
    joined = lookup.attach_id(orders, F.col("email"), customers, "email", "customer_id")
    assert joined.where("email = 'hot' AND customer_id = 0").count() == 20_000
    rows = joined.select("_pos", "customer_id", "payload").collect()
    assert len(rows) == 60_000
    joined.write.format("noop").mode("overwrite").save()
    final = joined.select("customer_id", "payload")
    final.collect()
    assert "skew=true" in plan(final)


def test_rows_without_key_spread_out(spark, small_partitions):
    orders = spark.range(20_000).selectExpr("id AS _pos", "CAST(NULL AS STRING) AS email")
    customers = spark.range(100).selectExpr("concat('k', id) AS email", "id")
    joined = lookup.attach_id(orders, F.col("email"), customers, "email", "customer_id")
    assert joined.where("customer_id IS NOT NULL").count() == 0
    keys = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in keys
    assert joined.count() == 20_000


def test_dedup_limits_each_key_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id AS _pos", "if(id < 5000, 'hot', 'cold') AS email")
    kept = dedup.first_per_key(rows, "email")
    text = plan(kept)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert [r["_pos"] for r in kept.collect()] == [0]


def test_reject_filter_stays_above_the_rules(spark):
    raw = spark.createDataFrame([("Ada", "bad", None)], "name string, email string, phone string")
    counts = report.reason_counts(rejected(classify(raw, "customers")), F.col("_errors"))
    assert plan(counts).count("ArrowEvalPython") == 1


def tables(spark, tmp_path):
    frames = {
        "orders": "SELECT id, id % 10 AS customer_id, if(id % 2 = 0, 'completed', 'pending') AS status, "
        "CAST(1 AS DECIMAL(12,2)) AS total_amount, TIMESTAMP_NTZ'2024-01-01' AS ordered_at, "
        "id AS created_at FROM range(100)",
        "order_items": "SELECT id, id % 100 AS order_id, id % 5 AS product_id, 2 AS quantity, "
        "CAST(1.5 AS DECIMAL(10,2)) AS unit_price FROM range(300)",
        "products": "SELECT id, concat('s', id) AS sku, 'n' AS name, id % 2 AS category_id FROM range(5)",
        "categories": "SELECT id, concat('c', id) AS name FROM range(2)",
        "customers": "SELECT id, 'n' AS name, concat('e', id) AS email FROM range(10)",
    }
    for name, sql in frames.items():
        spark.sql(sql).write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in frames}


def test_analytics_push_filters_and_prune_columns(spark, tmp_path):
    t = tables(spark, tmp_path)
    revenue = analytics.revenue_by_category(t["order_items"], t["products"], t["categories"], t["orders"])
    text = plan(revenue)
    assert "EqualTo(status,completed)" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    orders_scan = next(line for line in text.splitlines() if "EqualTo(status,completed)" in line)
    assert "created_at" not in orders_scan and "total_amount" not in orders_scan
    history = plan(analytics.customer_history(t["orders"], 3))
    assert "EqualTo(customer_id,3)" in history
    pending = plan(
        analytics.pending_dashboard(t["orders"], t["customers"], datetime(2024, 1, 1), datetime(2024, 2, 1))
    )
    assert "EqualTo(status,pending)" in pending and "GreaterThanOrEqual(ordered_at" in pending
    top = plan(analytics.top_products(t["order_items"], t["products"]))
    assert "TakeOrderedAndProject" in top


def test_order_shuffle_serves_the_distinct_count(spark, tmp_path, small_partitions):
    t = tables(spark, tmp_path)
    broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in broadcast.items():
        spark.conf.set(k, v)
    small = {n: F.broadcast(t[n]) for n in ("products", "categories")}
    revenue = analytics.revenue_by_category(
        t["order_items"], small["products"], small["categories"], t["orders"]
    )
    text = plan(revenue)
    # one exchange per side of the order join, one for the groups, one for the sort
    assert text.count("Exchange hashpartitioning") == 3


def test_profile_counts_values_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id", "id % 3 AS a", "'x' AS b")
    text = plan(profile.column_counts(frame, ["a", "b"]))
    assert text.count("Expand") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_staged_orders_stay_below_the_compilers_limit(spark, tmp_path):
    """Orders with their items, looked up and flagged, run as one compiled stage."""
    names = ("customer_email", "status", "total_amount", "ordered_at", "product_sku", "quantity", "unit_price")
    spark.range(1).select(*[F.lit("x").alias(n) for n in names], F.struct("id").alias("_pos")).write.parquet(
        f"{tmp_path}/raw"
    )
    spark.range(1).select("id", F.lit("x").alias("email")).write.parquet(f"{tmp_path}/customers")
    raw, customers = spark.read.parquet(f"{tmp_path}/raw"), spark.read.parquet(f"{tmp_path}/customers")
    staged = lookup.resolve_customer(classify(raw, "orders", keep=names[4:]), customers).withColumns(
        {"_ok": is_accepted(), "_mid": F.monotonically_increasing_id()}
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        physical = staged._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(physical)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < max(sizes) < int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
