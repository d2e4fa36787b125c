"""Profiles that are kept up to date load by load.

A stored table is a set of folders that never change: the buckets of a version, the loads of
an append table, what a compaction wrote. Each is counted and sketched once, when it is
first seen, and its sketch is kept beside the table. The profile of the table is the merge
of the sketches of its folders now, so profiling after a load reads that load's rows only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lauter.operators.profile import column_sketches, merged_counts, profile_of_counts
from lauter.schemas import PROFILE_COLUMNS, TABLES
from lauter.sinks import paths
from lauter.sinks.warehouse import Warehouse

_STORE = "_sketches"
_SKETCH = "folder string, column string, total_rows bigint, null_count bigint, sketch binary"


def _columns(name: str) -> list[str]:
    return PROFILE_COLUMNS.get(name) or [c for c in TABLES[name].schema.names if c != "id"]


def _kept(warehouse: Warehouse, name: str) -> DataFrame | None:
    store = warehouse.path(_STORE, name)
    files = [n for n in paths.names(warehouse.spark, store) if not n.startswith((".", "_"))]
    if not files:
        return None
    return warehouse.spark.read.schema(_SKETCH).parquet(*[f"{store}/{n}" for n in files])


def sketch_new_folders(warehouse: Warehouse, name: str) -> list[str]:
    """Sketch the folders of a table that have no sketch yet; returns them."""
    table = warehouse.keyed(name) if TABLES[name].keyed else warehouse.appended(name)
    folders = table.folders()
    kept = _kept(warehouse, name)
    known = set() if kept is None else {r[0] for r in kept.select("folder").distinct().collect()}
    new = [f for f in folders if f not in known]
    if new:
        files = warehouse.spark.read.schema(TABLES[name].schema).parquet(*[f"{table.root}/{f}" for f in new])
        # a file lies in its folder below the table's root
        inside = F.element_at(F.split("_metadata.file_path", f"/{name}/"), -1)
        rows = files.withColumn("folder", F.regexp_replace(inside, "/[^/]*$", ""))
        rows = rows.withColumn("folder", F.url_decode(F.replace("folder", F.lit("+"), F.lit("%2B"))))
        sketches = column_sketches(rows, _columns(name), "folder")
        sketches.write.parquet(warehouse.path(_STORE, name, uuid.uuid4().hex))
    return new


def profile_incremental(
    warehouse: Warehouse, name: str, ingested_rows: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """The profile of a stored table as :func:`lauter.operators.profile.profile_table` has it,
    with distinct counts within the error of the sketches."""
    sketch_new_folders(warehouse, name)
    table = warehouse.keyed(name) if TABLES[name].keyed else warehouse.appended(name)
    spark = warehouse.spark
    kept = _kept(warehouse, name)
    if kept is None:
        kept = spark.createDataFrame([], _SKETCH)
    now = spark.createDataFrame([(f,) for f in table.folders()], "folder string")
    # a folder may have been sketched twice, by two profiles at the same time
    sketches = kept.join(now, "folder", "left_semi").dropDuplicates(["folder", "column"])
    chosen = _columns(name) if columns is None else list(columns)
    counts = merged_counts(sketches.where(F.col("column").isin(chosen)))
    return profile_of_counts(counts, name, ingested_rows, chosen)
