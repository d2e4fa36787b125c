"""An append table: one folder per load, merged into few large files from time to time.

``load_id=<id>`` holds the rows of one load; writing the same load again replaces them.
:meth:`AppendedTable.compact` reads the loads that are there and writes their rows once
more, sorted as the table asks, below ``compact-<id>``. It counts when the next number in
``_compacted`` is claimed: that text names the compacted folders, which are read instead of
the loads it took. Readers that began before keep their files until the next compaction.
A row is rewritten once, so the work of all compactions grows with the rows and no more.

A load that comes again after its rows were compacted is already there: nothing is
written. That is what makes a replayed batch of a stream harmless.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lauter.schemas import Table
from lauter.sinks import paths
from lauter.sinks.buckets import NAMES_KEPT

LOAD, COMPACT = "load_id=", "compact-"
COMPACTED, TAKEN = "_compacted", "_taken"
FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Compaction:
    number: int = 0
    folders: list[str] = field(default_factory=list)
    loads: list[str] = field(default_factory=list)


class AppendedTable:
    def __init__(self, spark: SparkSession, root: str, table: Table) -> None:
        self.spark, self.root, self.table = spark, root, table

    def _latest(self) -> Compaction:
        while True:
            numbers = [n for n in paths.names(self.spark, f"{self.root}/{COMPACTED}") if n.isdigit()]
            if not numbers:
                return Compaction()
            text = paths.read(self.spark, f"{self.root}/{COMPACTED}/{numbers[-1]}")
            if text is not None:
                return Compaction(int(numbers[-1]), **json.loads(text))

    def _loads(self, latest: Compaction) -> list[str]:
        found = [n for n in paths.names(self.spark, self.root) if n.startswith(LOAD)]
        taken = set(latest.loads)
        return [n for n in found if n.removeprefix(LOAD) not in taken]

    def folders(self) -> list[str]:
        """The folders that hold the table's rows."""
        latest = self._latest()
        return [*latest.folders, *self._loads(latest)]

    def read(self) -> DataFrame | None:
        """All rows; None before the first load."""
        return self._rows(self.folders())

    def _rows(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        return self.spark.read.schema(self.table.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def append(self, rows: DataFrame, load_id: str) -> bool:
        """Write the rows of one load; False if they were compacted before."""
        if load_id in self._latest().loads or paths.exists(self.spark, f"{self.root}/{TAKEN}/{load_id}"):
            return False
        if self.table.cluster_by:
            rows = rows.sortWithinPartitions(*self.table.cluster_by)
        rows.write.mode("overwrite").parquet(f"{self.root}/{LOAD}{load_id}")
        return True

    def compact(self, at_least: int = 2) -> int:
        """Merge the loads written since the last time, if there are ``at_least`` so many;
        returns how many were merged. Loads may be written and read meanwhile."""
        before = self._latest()
        # what the last compaction took: no reader that began since then looks at it
        for load in before.loads:
            paths.write(self.spark, f"{self.root}/{TAKEN}/{load}", "")
            paths.delete(self.spark, f"{self.root}/{LOAD}{load}")
        loads = self._loads(before)
        if len(loads) < at_least:
            return 0
        size = sum(paths.size(self.spark, f"{self.root}/{load}") for load in loads)
        files = max(1, -(-size // FILE_BYTES))
        rows = self._rows(loads)
        if self.table.cluster_by:
            rows = rows.repartitionByRange(files, *self.table.cluster_by)
            rows = rows.sortWithinPartitions(*self.table.cluster_by)
        else:
            rows = rows.repartition(files)
        folder = f"{COMPACT}{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        names = [load.removeprefix(LOAD) for load in loads]
        text = json.dumps({"folders": [*before.folders, folder], "loads": names})
        number = before.number + 1
        if not paths.publish(self.spark, f"{self.root}/{COMPACTED}/{number:012d}", text):
            paths.delete(self.spark, f"{self.root}/{folder}")  # another one was faster
            return 0
        if number > NAMES_KEPT:
            paths.delete(self.spark, f"{self.root}/{COMPACTED}/{number - NAMES_KEPT:012d}")
        return len(loads)
