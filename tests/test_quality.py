from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lauter.operators import profile, report
from lauter.operators.merge import merge_rows, number_rows
from lauter.plans.generate import (
    STATUS_WEIGHTS,
    STATUSES,
    generate_customers,
    generate_orders,
    generate_products,
)


@pytest.mark.parametrize("approximate", [False, True])
def test_profile(spark, approximate):
    frame = spark.createDataFrame(
        [(1, "a", None), (2, "b", None), (3, "b", "x")], "id int, name string, phone string"
    )
    rows = profile.profile_table(frame, "customers", 5, approximate=approximate).collect()
    found = {r.column: r for r in rows}
    assert set(found) == {"name", "phone"}
    phone = found["phone"]
    assert (phone.total_rows, phone.null_count, phone.distinct_count) == (3, 2, 1)
    assert (phone.null_rate, phone.null_rate_pct) == (2 / 3, 66.67)
    assert phone.reconciliation_ok
    high = profile.high_null_columns(profile.profile_table(frame, "customers", 2))
    assert [(r.column, r.reconciliation_ok) for r in high.collect()] == [("phone", False)]


@pytest.mark.parametrize("approximate", [False, True])
def test_profile_of_an_empty_table(spark, approximate):
    frame = spark.createDataFrame([], "id int, name string")
    [row] = profile.profile_table(frame, "t", 0, approximate=approximate).collect()
    assert (row.total_rows, row.null_rate, row.distinct_rate_pct) == (0, 0.0, 0.0)
    assert row.reconciliation_ok


def test_value_distribution(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "status string")
    found = [tuple(r) for r in profile.value_distribution(frame, "status").collect()]
    assert found == [("b", 2), (None, 1), ("a", 1)]
    assert profile.value_distribution(frame, "status", 1).count() == 1


@pytest.fixture
def runs(spark):
    start = datetime(2024, 1, 1)
    rows = [
        (i, f"s{i % 2}", 10, i, "log", start + timedelta(hours=i), None if i == 4 else start + timedelta(hours=i, seconds=i * 2.5))
        for i in range(5)
    ]
    return spark.createDataFrame(
        rows,
        "id bigint, source string, rows_ingested bigint, rows_failed bigint, error_log string, "
        "started_at timestamp_ntz, finished_at timestamp_ntz",
    )


def test_run_pages(runs):
    page = report.runs_page(runs, limit=2, offset=1).collect()
    assert [(r.id, r.duration_seconds) for r in page] == [(3, 7.5), (2, 5.0)]
    assert report.latest_runs(runs, 1).first().duration_seconds is None
    assert report.run_by_id(runs, 3).first().error_log == "log"
    assert report.run_by_id(runs, 99).count() == 0
    for options in ({"limit": 0}, {"limit": 101}, {"offset": -1}):
        with pytest.raises(ValueError):
            report.runs_page(runs, **options)


def test_histogram_and_counters(runs):
    bars = {(r.source, r.le): r.runs for r in report.duration_histogram(runs).collect()}
    assert (bars["s0", "1"], bars["s0", "5"], bars["s0", "+Inf"]) == (1, 2, 2)
    assert (bars["s1", "5"], bars["s1", "10"], bars["s1", "600"]) == (1, 2, 2)
    totals = report.counters(runs, ["source"], "rows_failed", "total").collect()
    assert {r.source: r.total for r in totals} == {"s0": 6, "s1": 4}


def test_error_log_counts_repeats(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x")], "g string, why string")
    rows = report.error_log(frame, F.col("why"), "g").collect()
    assert {r.g: r.error_log for r in rows} == {"a": "x (x2)\ny", "b": "x"}


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", "x", 5), (2, "b", "y", 6)], "id int, k string, v string, p int")
    new = spark.createDataFrame([(8, "b", None, None), (9, "c", "z", 7)], "id int, k string, v string, p int")
    rows = merge_rows(old, new, ["k"], ["v", "p"], sticky=["p"]).collect()
    assert sorted((r.id, r.k, r.v, r.p, r["_loaded"]) for r in rows if r.v) == [
        (1, "a", "x", 5, False),
        (9, "c", "z", 7, True),
    ]
    [kept] = [r for r in rows if r.k == "b"]
    assert (kept.id, kept.v, kept.p) == (2, None, 6)


def test_numbers_are_dense_and_ordered(spark, tmp_path):
    path = str(tmp_path / "staged")
    spark.range(1000, numPartitions=7).withColumn("_mid", F.monotonically_increasing_id()).write.parquet(path)
    rows = number_rows(spark.read.parquet(path), 50, "n").collect()
    assert sorted(r.n for r in rows) == list(range(51, 1051))
    assert all(r.n == r.id + 51 for r in rows)


def test_generated_orders(spark):
    orders = generate_orders(spark, 20_000)
    assert generate_orders(spark, 20_000).exceptAll(orders).isEmpty()
    shares = {r.status: r["count"] / 20_000 for r in orders.groupBy("status").count().collect()}
    for status, weight in zip(STATUSES, STATUS_WEIGHTS, strict=True):
        assert abs(shares[status] - weight) < 0.02
    checks = orders.select(
        F.count_if(F.expr("total_amount <> CAST(quantity AS INT) * CAST(unit_price AS DECIMAL(12,2))")),
        F.min(F.col("quantity").cast("int")),
        F.max(F.col("quantity").cast("int")),
        F.avg((F.col("customer_phone") == "").cast("int")),
        F.min("ordered_at"),
        F.max("ordered_at"),
        F.countDistinct("product_sku"),
    ).first()
    assert (checks[0], checks[1], checks[2]) == (0, 1, 10)
    assert abs(checks[3] - 0.15) < 0.02
    assert "2020-01-01" <= checks[4] and checks[5] <= "2024-12-31 00:00:00"
    assert checks[6] > 10_000


def test_generated_products_and_customers(spark):
    products = generate_products(spark, 500)
    assert products.select("sku").distinct().count() == 500
    people = generate_customers(spark, 3000)
    assert people.columns == ["name", "email", "phone"]
    assert people.select("email").distinct().count() < 3000
