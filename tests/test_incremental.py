"""Incremental profiles against exact ones, and records from a producer."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lauter.operators import profile
from lauter.operators.profile import SKETCH_ERROR, profile_table
from lauter.plans import profiles
from lauter.plans.load import run_entity
from lauter.plans.profiles import profile_incremental, sketch_new_folders
from lauter.sinks import buckets
from lauter.sources import Producer, register_producer


def people(spark, low, high):
    return spark.range(low, high).selectExpr(
        "concat('N', id % 97) AS name", "concat('u', id, '@b.co') AS email", "IF(id % 3 = 0, NULL, '+1-555-0101') AS phone", "id"
    )


def compared(warehouse, name, ingested=10**6):
    """Exact and sketched profiles agree; returns the relative errors of the distinct counts."""
    exact = {r.column: r for r in profile_table(warehouse.table(name), name, ingested, profiles._columns(name)).collect()}
    found = {r.column: r for r in profile_incremental(warehouse, name, ingested).collect()}
    assert set(exact) == set(found)
    errors = []
    for column, e in exact.items():
        f = found[column]
        assert (f.total_rows, f.null_count, f.null_rate, f.position) == (e.total_rows, e.null_count, e.null_rate, e.position)
        assert f.reconciliation_ok == e.reconciliation_ok
        errors.append(abs(f.distinct_count - e.distinct_count) / max(e.distinct_count, 1))
    return errors


def test_profile_within_its_bound(spark, warehouse):
    for low in (0, 20_000):
        run_entity(warehouse, people(spark, low, low + 30_000), "customers", order_by=["id"])
        assert max(compared(warehouse, "customers")) < 3 * SKETCH_ERROR


def test_few_values_are_exact(spark, warehouse):
    run_entity(warehouse, people(spark, 0, 50), "customers", order_by=["id"])
    assert compared(warehouse, "customers") == [0, 0, 0]


def test_a_profile_reads_only_what_is_new(spark, warehouse, monkeypatch):
    monkeypatch.setattr(buckets, "SPREAD", 1)
    warehouse.rows_per_bucket = 100
    run_entity(warehouse, people(spark, 0, 1_000), "customers", order_by=["id"])
    assert len(sketch_new_folders(warehouse, "customers")) == 16
    assert sketch_new_folders(warehouse, "customers") == []
    run_entity(warehouse, people(spark, 5, 6), "customers", order_by=["id"])
    assert len(sketch_new_folders(warehouse, "customers")) == 1
    assert max(compared(warehouse, "customers")) < 3 * SKETCH_ERROR


def test_profile_of_an_append_table(spark, warehouse):
    run_entity(warehouse, people(spark, 0, 5), "customers", order_by=["id"])
    order = "SELECT concat('u', id % 5, '@b.co') customer_email, id total_amount, '2024-01-01' ordered_at, 'new' status, id FROM range({0})"
    for n in (10, 20):
        run_entity(warehouse, spark.sql(order.format(n)), "orders", order_by=["id"])
        assert len(sketch_new_folders(warehouse, "orders")) == 1
    assert compared(warehouse, "orders") == [0, 0, 0]
    warehouse.compact("orders")
    assert len(sketch_new_folders(warehouse, "orders")) == 1
    assert compared(warehouse, "orders") == [0, 0, 0]


def test_profile_of_nothing(spark, warehouse):
    assert compared(warehouse, "customers") == [0, 0, 0]


def test_sketches_merge_over_any_split(spark):
    frame = spark.range(60_000).selectExpr("id % 20000 AS a", "IF(id % 2 = 0, NULL, 'x') AS b", "id % 7 AS part")
    whole = {r.column: r for r in profile.merged_counts(profile.column_sketches(frame, ["a", "b"])).collect()}
    parts = {r.column: r for r in profile.merged_counts(profile.column_sketches(frame, ["a", "b"], "part")).collect()}
    assert (parts["a"].total_rows, parts["b"].null_count, parts["b"].distinct_count) == (60_000, 30_000, 1)
    assert whole["a"].total_rows == 60_000
    assert all(abs(p["a"].distinct_count - 20_000) < 3 * SKETCH_ERROR * 20_000 for p in (whole, parts))


class Letters(Producer):
    """Letters of a file that grows."""

    schema = "number bigint, letter string"

    def count(self):
        with open(self.options["path"]) as file:
            return len(file.read())

    def records(self, begin, end):
        with open(self.options["path"]) as file:
            text = file.read()[begin:end]
        if self.options.get("arrow"):
            yield pa.RecordBatch.from_pydict({"number": list(range(begin, end)), "letter": list(text)})
        else:
            yield from zip(range(begin, end), text, strict=True)


@pytest.mark.parametrize("arrow", ["", "yes"])
def test_a_producer_in_batch_and_stream(spark, tmp_path, arrow):
    register_producer(spark, "letters", Letters)
    path = tmp_path / "letters.txt"
    path.write_text("abcdefghij")
    options = {"path": str(path), "rangeSize": "3", "arrow": arrow}
    frame = spark.read.format("letters").options(**options).load()
    assert sorted(tuple(r) for r in frame.collect()) == list(enumerate("abcdefghij"))
    assert frame.select(F.spark_partition_id()).distinct().count() == 4
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def drain():
        stream = spark.readStream.format("letters").options(**options).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start(out).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    assert drain() == list(enumerate("abcdefghij"))
    path.write_text("abcdefghijklm")
    assert drain() == list(enumerate("abcdefghijklm"))
    assert drain() == list(enumerate("abcdefghijklm"))


def test_a_producer_without_records(spark, tmp_path):
    register_producer(spark, "letters", Letters)
    (tmp_path / "none").write_text("")
    assert spark.read.format("letters").option("path", str(tmp_path / "none")).load().collect() == []


def test_a_producer_feeds_a_load(spark, warehouse, tmp_path):
    class People(Letters):
        schema = "name string, email string, place bigint"

        def records(self, begin, end):
            yield from ((c.upper(), f"{c}@b.co", n) for n, c in super().records(begin, end))

    register_producer(spark, "people", People)
    (tmp_path / "p").write_text("abca")
    frame = spark.read.format("people").option("path", str(tmp_path / "p")).load()
    result = run_entity(warehouse, frame, "customers", order_by=["place"])
    assert (result.rows_ingested, result.rows_duplicate) == (3, 1)
