"""Headline queries and pipeline throughput; prints one JSON line.

Tables come from $BENCH_SF_DIR, cores from $BENCH_CPUS. Every query is run twice
into a sink that takes all rows, and the faster run counts. The pipeline figures
are rows per second from source file to loaded table, session start excluded.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from lauter.plans.catalog import QUERIES
from lauter.plans.generate import generate_customers
from lauter.plans.load import run_entity
from lauter.session import build, scratch_path
from lauter.sinks import Warehouse
from lauter.sources import read_csv, read_ndjson, read_parquet

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
ROWS = int(os.environ.get("BENCH_ROWS", "400000"))
HEADLINE = [
    "q1_customer_history",
    "q2_pending_dashboard",
    "q3_revenue_by_category",
    "q4_daily_run_summary",
    "q5_top_products",
    "clean_records",
    "clean_strip_control",
    "validate_customers",
    "validate_products",
    "validate_orders",
    "validate_items",
    "dedup_customers",
    "orders_fk_accept",
    "items_fk_accept",
    "orphans",
    "profile_customer",
    "profile_lineitem",
    "value_distribution",
    "ndjson_lines",
    "page_flatten",
    "duration_histogram",
    "upsert_customers",
    "append_orders",
]


def session() -> SparkSession:
    spark = build(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    return spark


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def seconds(work, runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        work()
        best = min(best, time.perf_counter() - start)
    return best


def throughput(spark: SparkSession) -> dict[str, float]:
    """Rows per second of reading and of the full customer pipeline, per format."""
    people = generate_customers(spark, ROWS).repartition(CPUS)
    base = scratch_path(spark, "bench")
    people.write.option("header", True).csv(f"{base}/csv")
    people.write.json(f"{base}/ndjson")
    people.write.parquet(f"{base}/parquet")
    readers = {"csv": read_csv, "ndjson": read_ndjson, "parquet": read_parquet}
    found = {}
    for kind, read in readers.items():
        path = f"{base}/{kind}"

        def load(read=read, path=path) -> None:
            warehouse = Warehouse(spark, scratch_path(spark, "bench-warehouse"))
            run_entity(warehouse, read(spark, path), "customers")

        found[f"read_{kind}"] = ROWS / seconds(lambda read=read, path=path: drain(read(spark, path)))
        found[f"pipeline_{kind}"] = ROWS / seconds(load)
    return {name: round(rate) for name, rate in found.items()}


def main() -> None:
    spark = session()
    timings = {}
    for name in HEADLINE:
        query = QUERIES[name]
        timings[name] = round(seconds(lambda query=query: drain(query(spark, FOLDER))), 3)
    rates = throughput(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "rows_per_second": rates,
                "pipeline_rows": ROWS,
            }
        )
    )


if __name__ == "__main__":
    main()
