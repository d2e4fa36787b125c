"""Table storage on plain Parquet (K1, K2, K5, K6).

Keyed tables are hash buckets under claimed versions (:mod:`lauter.sinks.buckets`): a
failed or half-written load is never read, readers of the version before keep their
files, and loads at the same time do not lose each other's rows. Append tables have one
folder ``load_id=<id>`` per load, so replaying a load replaces its own rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lauter.schemas import STEPS, TABLES, Table
from lauter.sinks import paths
from lauter.sinks.appends import AppendedTable
from lauter.sinks.buckets import NAMES_KEPT, ROWS_PER_BUCKET, BucketedTable

_IDS = "_ids"


class Warehouse:
    """The six tables below one root folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.rows_per_bucket = rows_per_bucket

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    # -- definition ----------------------------------------------------------

    def create(self) -> Warehouse:
        """Create the tables that do not exist yet (K5); a new table is an empty folder."""
        for name in TABLES:
            paths.make(self.spark, self.path(name))
        return self

    def create_views(self, prefix: str = "") -> None:
        """Register every table, and ``pending_orders``, as temporary views (K6)."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")
        self.spark.sql(
            f"CREATE OR REPLACE TEMP VIEW {prefix}pending_orders AS "
            f"SELECT * FROM {prefix}orders WHERE status = 'pending'"
        )

    # -- reading -------------------------------------------------------------

    def keyed(self, name: str) -> BucketedTable:
        return BucketedTable(self.spark, self.path(name), TABLES[name], self.rows_per_bucket)

    def appended(self, name: str) -> AppendedTable:
        return AppendedTable(self.spark, self.path(name), TABLES[name])

    def table(self, name: str) -> DataFrame:
        table = TABLES[name]
        if table.keyed:
            rows = self.keyed(name).read()
            return _no_rows(self.spark, table.schema) if rows is None else rows
        rows = self.appended(name).read()
        return _no_rows(self.spark, table.schema) if rows is None else rows

    # -- ids -----------------------------------------------------------------

    def reserve_ids(self, name: str, count: int) -> int:
        """Set ``count`` ids aside and return the number before the first.

        The high-water mark is published before any row with such an id is written. Marks
        are numbered, so that writers who count on from the same mark want the same name,
        and only one of them gets it.
        """
        folder = self.path(name, _IDS)
        while True:
            marks = [n for n in paths.names(self.spark, folder) if n.isdigit()]
            text = paths.read(self.spark, f"{folder}/{marks[-1]}") if marks else "0"
            if text is None:  # dropped since the listing: there are newer ones
                continue
            base, turn = int(text), int(marks[-1]) if marks else 0
            if count == 0:
                return base
            if paths.publish(self.spark, f"{folder}/{turn + 1:012d}", str(base + count)):
                for old in marks[:-NAMES_KEPT]:
                    paths.delete(self.spark, f"{folder}/{old}")
                return base

    # -- metrics -------------------------------------------------------------

    def save_steps(self, load_id: str, steps: list[dict]) -> None:
        """What the steps of one load did, as JSON lines; a load that is done again replaces
        its own."""
        lines = "".join(json.dumps(step, default=str) + "\n" for step in steps)
        paths.write(self.spark, self.path(STEPS.name, f"{load_id}.json"), lines)

    def steps(self) -> DataFrame:
        """One row per entity and batch of all runs: counts, status and times."""
        folder = self.path(STEPS.name)
        if not paths.exists(self.spark, folder):
            return _no_rows(self.spark, STEPS.schema)
        return self.spark.read.schema(STEPS.schema).json(folder)

    # -- writing -------------------------------------------------------------

    def append(self, name: str, rows: DataFrame, load_id: str) -> None:
        """Add the rows of one load (K1); the same ``load_id`` replaces its rows."""
        self.appended(name).append(self._stored(TABLES[name], rows), load_id)

    def compact(self, name: str, at_least: int = 2) -> int:
        """Merge the small files of an append table's loads; returns how many were merged."""
        return self.appended(name).compact(at_least)

    def upsert(self, name: str, rows: DataFrame, expected: int | None = None) -> int:
        """Merge rows that are unique on the table's key (K2) and return their number.

        Every incoming row has an id; only the ids of new keys are used.
        """
        return self.keyed(name).upsert(self._stored(TABLES[name], rows), expected)

    def _stored(self, table: Table, rows: DataFrame) -> DataFrame:
        """The table's columns in its types, ``created_at`` and absent ones filled in."""
        columns = []
        for field in table.schema.fields:
            if field.name in rows.columns:
                value = F.col(field.name)
            elif field.name == "created_at":
                value = F.current_timestamp()
            else:
                value = F.lit(None)
            columns.append(value.cast(field.dataType).alias(field.name))
        return rows.select(*columns)


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where("false").select(*columns)
