"""Structured Streaming file ingest: the batch load applied to every micro-batch.

State across batches lives in the tables: keyed entities are upserted, so a later
batch overrides an earlier one, and an append writes the folder of its own
``(run, batch)``. A batch that is replayed after a failure therefore leaves the
tables as if it had run once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lauter.plans.load import Run
from lauter.schemas import TABLES
from lauter.sinks.warehouse import Warehouse
from lauter.sources.json_records import line_records
from lauter.sources.tables import with_position


def stream_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    *,
    delimiter: str = ",",
    multiline: bool = True,
    files_per_batch: int = 1,
) -> DataFrame:
    """New header-CSV files of a folder, every column a string.

    ``multiline`` as for :func:`lauter.sources.read_csv`. A file whose header is not
    ``columns`` fails the batch.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return with_position(
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", delimiter)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
    )


def stream_ndjson(spark: SparkSession, path: str, *, files_per_batch: int = 1) -> DataFrame:
    """New newline-delimited JSON files of a folder, as VARIANT records."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return line_records(with_position(lines))


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    files_per_batch: int = 1,
) -> DataFrame:
    """New Parquet files of a folder, a bounded number per batch.

    ``schema`` is by default that of the files there now. Files of another schema fail the
    batch if :func:`stream_entity` is given the same ``schema``.
    """
    schema = spark.read.parquet(path).schema if schema is None else schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return with_position(stream.parquet(path))


def refuse_other_schemas(spark: SparkSession, files: list[str], schema: T.StructType) -> None:
    """Raise if a Parquet file has other columns or types than ``schema``.

    Parquet readers fill absent columns with NULL and pass over others, so that a renamed
    column would go unnoticed. Reads the footers of a batch's files, whose number
    ``files_per_batch`` bounds.
    """
    expected = {f.name: f.dataType.simpleString() for f in schema.fields}
    for path in sorted(files):
        found = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}
        if found != expected:
            odd = sorted(set(found.items()) ^ set(expected.items()))
            raise ValueError(f"{path} has another schema: {', '.join(' '.join(o) for o in odd)}")


def stream_entity(
    warehouse: Warehouse,
    raw: DataFrame,
    entity: str,
    *,
    run_id: str,
    checkpoint: str,
    source: str | None = None,
    once: bool = True,
    schema: T.StructType | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Load a raw stream batch by batch; ``run_id`` must stay the same across restarts.

    ``once`` processes what is there and stops; otherwise the query keeps running.
    Every batch has its own audit row and its own step, and its rows are dealt to
    tasks by their size, however few its files; small batches stay in one. ``schema`` is what files of a
    Parquet stream must have. With ``compact_every`` an append table is compacted each time
    so many batches were loaded.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # a batch is few files, and a file may be one task: its rows are dealt out by their size
        batch = batch.hint("rebalance")
        with Run(warehouse, source or entity, run_id=run_id, batch=str(batch_id)) as run:
            if schema is not None:
                run.examine = lambda files: refuse_other_schemas(batch.sparkSession, files, schema)
            run.load(batch, entity)
        if compact_every and not TABLES[entity].keyed and (batch_id + 1) % compact_every == 0:
            warehouse.compact(entity)

    writer = raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
