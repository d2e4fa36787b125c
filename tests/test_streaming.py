import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lauter.operators.report import BATCH_BUCKETS, counters, duration_histogram
from lauter.plans.load import run_entity
from lauter.sinks import paths
from lauter.streaming import stream_csv, stream_entity, stream_ndjson, stream_parquet


def test_customers_stream_later_files_win(spark, warehouse, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "1.csv").write_text("name,email,phone\nAda,a@b.co,\nBad,nope,\n")
    checkpoint = str(tmp_path / "cp")

    def drain():
        raw = stream_csv(spark, str(landing), ["name", "email", "phone"])
        query = stream_entity(warehouse, raw, "customers", run_id="s", checkpoint=checkpoint)
        query.awaitTermination()

    drain()
    (landing / "2.csv").write_text("name,email,phone\nAdele,A@b.co,+1-555-0101\nBen,b@b.co,\n")
    drain()
    drain()
    rows = warehouse.table("customers").select("email", "name").collect()
    assert sorted(tuple(r) for r in rows) == [("a@b.co", "Adele"), ("b@b.co", "Ben")]
    runs = warehouse.table("pipeline_runs").orderBy("id").collect()
    assert [(r.rows_ingested, r.rows_failed) for r in runs] == [(1, 1), (2, 0)]


def test_replayed_batch_appends_once(spark, warehouse, tmp_path):
    run_entity(
        warehouse, spark.sql("SELECT 'Ada' name, 'a@b.co' email"), "customers", order_by=["email"]
    )
    landing = tmp_path / "in"
    landing.mkdir()
    for n in (1, 2):
        (landing / f"{n}.ndjson").write_text(
            '{"customer_email": "a@b.co", "ordered_at": "2024-01-01"}\nBROKEN\n\n'
        )

    def drain(checkpoint):
        raw = stream_ndjson(spark, str(landing))
        stream_entity(
            warehouse, raw, "orders", run_id="s", checkpoint=str(tmp_path / checkpoint)
        ).awaitTermination()

    drain("first")
    assert warehouse.table("orders").count() == 2
    drain("lost")  # a lost checkpoint replays the same batches
    assert warehouse.table("orders").count() == 2


def test_csv_stream_refuses_another_header(spark, warehouse, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "1.csv").write_text("email,name,phone\na@b.co,Ada,\n")
    raw = stream_csv(spark, str(landing), ["name", "email", "phone"])
    query = stream_entity(warehouse, raw, "customers", run_id="s", checkpoint=str(tmp_path / "cp"))
    with pytest.raises(StreamingQueryException, match="(?i)header"):
        query.awaitTermination()
    assert warehouse.table("customers").count() == 0
    [step] = warehouse.steps().collect()
    assert (step.entity, step.status, step.rows_ingested) == ("customers", "failed", 0)


ORDER = "customer_email string, status string, total_amount string, ordered_at string"


def order_rows(n, batch):
    return [("a@b.co", "new", f"{batch}.{i:02d}", "2024-01-01") for i in range(n)]


def drain_parquet(spark, warehouse, landing, checkpoint, **options):
    schema = T.StructType.fromDDL(ORDER)
    raw = stream_parquet(spark, landing, schema)
    stream_entity(
        warehouse, raw, "orders", run_id="p", checkpoint=checkpoint, schema=schema, **options
    ).awaitTermination()


def parquet_file(folder, name, rows, names=("customer_email", "status", "total_amount", "ordered_at")):
    columns = list(zip(*rows, strict=True))
    pq.write_table(pa.table(dict(zip(names, columns, strict=True))), str(folder / name))


def test_parquet_stream_is_compacted(spark, warehouse, tmp_path):
    run_entity(warehouse, spark.sql("SELECT 'Ada' name, 'a@b.co' email"), "customers", order_by=["email"])
    landing = tmp_path / "in"
    landing.mkdir()
    for b in range(12):
        parquet_file(landing, f"{b:02d}.parquet", order_rows(3, b))
    drain_parquet(spark, warehouse, str(landing), str(tmp_path / "cp"), compact_every=5)
    orders = warehouse.table("orders")
    amounts = sorted(f"{r.total_amount}" for r in orders.collect())
    assert amounts == sorted(f"{b}.{i:02d}" for b in range(12) for i in range(3))
    assert orders.select("id").distinct().count() == 36
    # two compacted folders and the two loads after them
    table = warehouse.appended("orders")
    assert (len(table._latest().folders), len(table._loads(table._latest()))) == (2, 2)
    assert len(orders.inputFiles()) <= 2 + 2 * 2
    steps = warehouse.steps().where("entity = 'orders'")
    assert steps.agg(F.sum("rows_ingested"), F.count("*")).first()[:] == (36, 12)
    # a lost checkpoint replays every batch, also those that were compacted
    drain_parquet(spark, warehouse, str(landing), str(tmp_path / "lost"))
    assert sorted(f"{r.total_amount}" for r in warehouse.table("orders").collect()) == amounts


@pytest.mark.parametrize(
    ("names", "values"),
    [
        (("customer_email", "status", "total", "ordered_at"), ("a@b.co", "x", "1", "2024-01-01")),
        (("customer_email", "status", "total_amount"), ("a@b.co", "x", "1")),
        (("customer_email", "status", "total_amount", "ordered_at"), ("a@b.co", "x", 1.5, "2024-01-01")),
    ],
)
def test_parquet_stream_refuses_another_schema(spark, warehouse, tmp_path, names, values):
    landing = tmp_path / "in"
    landing.mkdir()
    parquet_file(landing, "1.parquet", order_rows(2, 1))
    parquet_file(landing, "2.parquet", [values], names)
    # another type is refused by the reader itself
    message = "another schema|CONVERT|[Cc]onvert"
    with pytest.raises(StreamingQueryException, match=message):
        drain_parquet(spark, warehouse, str(landing), str(tmp_path / "cp"))
    statuses = [r.status for r in warehouse.steps().orderBy("started_at").collect()]
    assert statuses == ["success", "failed"]


def test_compaction_beside_loads(spark, warehouse):
    rows = spark.sql("SELECT id, id AS order_id, id AS product_id, 1 AS quantity, 1.5 AS unit_price FROM range(10)")
    table = warehouse.appended("order_items")
    assert table.compact() == 0
    for i in range(4):
        warehouse.append("order_items", rows.withColumn("id", F.lit(i)), f"l{i}")
    reader = warehouse.table("order_items")
    assert warehouse.compact("order_items", at_least=5) == 0
    assert warehouse.compact("order_items") == 4
    assert reader.count() == 40 == warehouse.table("order_items").count()  # files of old readers stay
    warehouse.append("order_items", rows.withColumn("id", F.lit(9)), "l9")
    assert not table.append(warehouse._stored(table.table, rows), "l2")  # compacted: it is there
    assert warehouse.table("order_items").count() == 50
    warehouse.append("order_items", rows.limit(3), "l9")  # not compacted: replaced
    assert warehouse.table("order_items").count() == 43
    warehouse.append("order_items", rows, "l10")
    assert warehouse.compact("order_items") == 2
    assert warehouse.table("order_items").count() == 53
    assert not table.append(warehouse._stored(table.table, rows), "l0")
    assert len(warehouse.table("order_items").inputFiles()) == 2


def test_two_compactions_at_once(spark, warehouse):
    rows = spark.sql("SELECT id, id AS order_id, id AS product_id, 1 AS quantity, 1.5 AS unit_price FROM range(10)")
    for i in range(3):
        warehouse.append("order_items", rows, f"l{i}")
    table, late = warehouse.appended("order_items"), warehouse.appended("order_items")
    late._rows = lambda folders: (table.compact(), type(late)._rows(late, folders))[1]
    assert late.compact() == 0  # the other one claimed the number first
    assert warehouse.table("order_items").count() == 30
    assert [n for n in paths.names(spark, table.root) if n.startswith("compact-")] == table._latest().folders


def test_steps_of_a_load(spark, warehouse, tmp_path):
    """Entity, status, rows, duration, and a chunk for every task of the scan."""
    frame = spark.range(0, 40, 1, 4).selectExpr(
        "concat('N', id) AS name", "IF(id % 10 = 3, 'bad', concat('u', id, '@b.co')) AS email", "id"
    )
    result = run_entity(warehouse, frame, "customers", source="feed", order_by=["id"])
    assert (result.rows_ingested, result.rows_failed, result.chunks_processed) == (36, 4, 4)
    with pytest.raises(Exception, match="boom"):
        run_entity(warehouse, spark.sql("SELECT raise_error('boom') name, 1 i"), "categories", source="feed", order_by=["i"])
    run_entity(warehouse, frame, "generic")
    found = {r.entity: r for r in warehouse.steps().collect()}
    assert set(found) == {"customers", "categories"}
    step = found["customers"]
    assert (step.status, step.rows_ingested, step.rows_failed, step.chunks, step.source) == ("success", 36, 4, 4, "feed")
    assert step.finished_at > step.started_at and found["categories"].status == "failed"
    counted = counters(warehouse.steps(), ["source", "entity"], "rows_ingested", "n").collect()
    assert sorted(tuple(r) for r in counted) == [("feed", "categories", 0), ("feed", "customers", 36)]
    bars = duration_histogram(warehouse.steps(), ("source", "entity", "status"), BATCH_BUCKETS).collect()
    assert len(bars) == 2 * (len(BATCH_BUCKETS) + 1)
    assert {(r.entity, r.status): r.runs for r in bars if r.le == "+Inf"} == {
        ("customers", "success"): 1, ("categories", "failed"): 1,
    }


def test_one_file_of_a_batch_is_judged_by_many_tasks(spark, warehouse, tmp_path):
    rows = spark.range(20_000).selectExpr("concat('N', id) AS name", "concat('u', id, '@b.co') AS email")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), rows.schema)
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(least)
    spark.conf.set(least, "1k")
    try:
        query = stream_entity(warehouse, stream, "customers", run_id="one", checkpoint=str(tmp_path / "c"), schema=rows.schema)
        query.awaitTermination()
    finally:
        spark.conf.set(least, before)
    assert warehouse.steps().first().chunks > 4
    assert warehouse.table("customers").count() == 20_000
