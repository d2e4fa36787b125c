"""A keyed table in hash buckets, changed by claimed versions (K2).

``_versions/<n>`` is a short JSON text that names the folder of every bucket; the greatest
``n`` is the table. A commit writes the buckets it touches below a folder of its own and
then claims the next number. Files of other buckets are not read, not written and keep
their names, so the work of a load grows with the load and not with the table.

Two writers can prepare at the same time. Only one can claim a number; the other finds out
which of its buckets have changed since it read them, merges its rows into those again and
claims the number after. Nothing else is repeated, and no row of either is lost.

Rows go to bucket ``xxhash64(key) mod buckets``. When a commit takes the mean bucket over
twice its size, it writes the whole table into a multiple of the buckets; that happens each
time the table has doubled, so it is paid for by the rows that came in. Buckets have
``ROWS_PER_BUCKET`` rows, but a table of fewer than ``SPREAD`` such buckets is cut into
smaller ones, so that many tasks write it.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lauter.operators.merge import LOADED, NEW_KEY, merge_rows
from lauter.schemas import Table
from lauter.sinks import paths

log = logging.getLogger(__name__)

ROWS_PER_BUCKET = 1_000_000
SPREAD = 64
# data of this many versions, and the names of many more: a writer that is late by fewer
# versions finds its number taken
VERSIONS_KEPT = 2
NAMES_KEPT = 64
VERSIONS, INCOMING = "_versions", "_incoming"
BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    number: int = 0
    buckets: int = 0
    rows: int = 0
    folders: dict[int, str] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "rows": self.rows, "folders": self.folders})

    @classmethod
    def parse(cls, number: int, text: str) -> Version:
        found = json.loads(text)
        folders = {int(bucket): folder for bucket, folder in found["folders"].items()}
        return cls(number, found["buckets"], found["rows"], folders)


class BucketedTable:
    def __init__(
        self, spark: SparkSession, root: str, table: Table, rows_per_bucket: int = ROWS_PER_BUCKET
    ) -> None:
        self.spark, self.root, self.table = spark, root, table
        self.rows_per_bucket = rows_per_bucket

    # -- reading -------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return [int(n) for n in paths.names(self.spark, f"{self.root}/{VERSIONS}") if n.isdigit()]

    def _name(self, number: int) -> str:
        return f"{self.root}/{VERSIONS}/{number:012d}"

    def latest(self) -> Version:
        """The newest version; number 0, without buckets, before the first load."""
        while True:
            numbers = self._numbers()
            if not numbers:
                return Version()
            text = paths.read(self.spark, self._name(numbers[-1]))
            if text is not None:  # else it was dropped since the listing: there are newer ones
                return Version.parse(numbers[-1], text)

    def read(self, version: Version | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The rows of a version or of some of its buckets; None if no file holds any."""
        version = self.latest() if version is None else version
        chosen = version.folders if buckets is None else set(buckets) & set(version.folders)
        folders = [f"{self.root}/{version.folders[b]}" for b in sorted(chosen)]
        if not folders:
            return None
        return self.spark.read.schema(self.table.schema).parquet(*folders)

    def folders(self) -> list[str]:
        """The folders that hold the newest version's rows."""
        return sorted(self.latest().folders.values())

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.table.key), F.lit(buckets)).cast("int")

    # -- writing -------------------------------------------------------------

    def upsert(self, rows: DataFrame, expected: int | None = None) -> int:
        """Merge rows that are unique on the key; returns their number.

        ``expected`` is the number of rows, or a bound, if the caller knows one. The rows may
        be read again after a conflict, so they must be the same each time.
        """
        seen = self.latest()
        if expected is None and not self._settled(seen):
            expected = rows.count()
        buckets = self._wanted(seen, expected or 0)
        staged = f"{self.root}/{INCOMING}/{uuid.uuid4().hex}"
        if buckets == seen.buckets > 1:
            # which buckets a load touches is asked before it is merged: its rows are made once
            rows.write.parquet(staged)
            rows = self.spark.read.schema(rows.schema).parquet(staged)
            touched = self._touched(rows, buckets)
        else:
            touched = set(range(buckets))
        written, loaded, fresh = self._merge(seen, rows, touched, buckets)
        while True:
            now = self.latest()
            if now.number != seen.number:
                log.info("%s: version %d came before this load", self.table.name, now.number)
                if now.buckets != seen.buckets:  # every row may have moved
                    return self.upsert(rows, expected)
                changed = {b for b in touched if now.folders.get(b) != seen.folders.get(b)}
                if buckets != now.buckets:
                    changed = touched
                if changed:
                    mine = rows if changed == touched else rows.where(self.bucket(buckets).isin(sorted(changed)))
                    again, _, _ = self._merge(now, mine, changed, buckets)
                    written |= again
                seen = now
            kept = now.folders if buckets == now.buckets else {}
            version = Version(now.number + 1, buckets, now.rows + fresh, kept | written)
            if self._claim(version):
                self._drop_old(version)
                paths.delete(self.spark, staged)
                return loaded

    def _rows_of(self, buckets: int) -> int:
        """The size of a bucket in a table of so many: it grows with them up to the full one."""
        return max(self.rows_per_bucket * min(buckets, SPREAD) // SPREAD, 1)

    def _settled(self, version: Version) -> bool:
        """True if no load of ordinary size changes the number of buckets."""
        return bool(version.buckets) and version.rows < version.buckets * self._rows_of(version.buckets)

    def _wanted(self, version: Version, more: int) -> int:
        rows, buckets = version.rows + more, max(version.buckets, 1)
        if version.buckets and rows <= 2 * buckets * self._rows_of(buckets):
            return buckets
        while rows > buckets * self._rows_of(buckets):
            buckets *= 2
        return buckets

    def _touched(self, rows: DataFrame, buckets: int) -> set[int]:
        """At most one number per bucket."""
        return {r[0] for r in rows.select(self.bucket(buckets)).distinct().collect()}

    def _merge(
        self, version: Version, rows: DataFrame, touched: set[int], buckets: int
    ) -> tuple[dict[int, str], int, int]:
        """Write the touched buckets anew: their folders, rows that came in, new keys.

        One shuffle, by bucket; a bucket is one task and one file.
        """
        moved = buckets != version.buckets
        old = self.read(version, None if moved else touched)
        new = rows.withColumn(BUCKET, self.bucket(buckets))
        if old is not None:
            old = old.withColumn(BUCKET, self.bucket(buckets))
        tasks = min(buckets if moved else max(len(touched), 1), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        merged = merge_rows(
            old, new, self.table.key, self.table.updates, self.table.sticky, within=BUCKET, tasks=tasks
        )
        counts = Observation()
        counted = merged.observe(
            counts, F.count_if(LOADED).alias("loaded"), F.count_if(NEW_KEY).alias("fresh")
        ).drop(LOADED, NEW_KEY)
        commit = uuid.uuid4().hex
        counted.write.partitionBy(BUCKET).parquet(f"{self.root}/{commit}")
        found = paths.names(self.spark, f"{self.root}/{commit}")
        numbers = [int(n.partition("=")[2]) for n in found if n.startswith(f"{BUCKET}=")]
        folders = {b: f"{commit}/{BUCKET}={b}" for b in numbers}
        return folders, counts.get["loaded"], counts.get["fresh"]

    def _claim(self, version: Version) -> bool:
        numbers = self._numbers()
        if numbers and numbers[-1] >= version.number:
            return False
        return paths.publish(self.spark, self._name(version.number), version.text())

    def _drop_old(self, newest: Version) -> None:
        """Files that only versions before the last ``VERSIONS_KEPT`` name, and very old names."""
        numbers = [n for n in self._numbers() if n <= newest.number]
        kept: set[str] = set(newest.folders.values())
        for number in numbers[-VERSIONS_KEPT:-1]:
            kept |= self._folders(number)
        for number in numbers[-VERSIONS_KEPT - 1 : -VERSIONS_KEPT]:
            gone = self._folders(number) - kept
            whole = {f.partition("/")[0] for f in gone} - {f.partition("/")[0] for f in kept}
            for folder in whole | {f for f in gone if f.partition("/")[0] not in whole}:
                paths.delete(self.spark, f"{self.root}/{folder}")
        for number in numbers[:-NAMES_KEPT]:
            paths.delete(self.spark, self._name(number))

    def _folders(self, number: int) -> set[str]:
        text = paths.read(self.spark, self._name(number))
        return set(Version.parse(number, text).folders.values()) if text else set()

    def vacuum(self) -> list[str]:
        """Delete what no kept version names, the remains of loads that failed, and list it.

        To be called while no load runs, as a load's files have no version yet.
        """
        kept = [f for n in self._numbers()[-VERSIONS_KEPT:] for f in self._folders(n)]
        commits = {f.partition("/")[0] for f in kept}
        lost = []
        for commit in paths.names(self.spark, self.root):
            if commit.startswith(("_", ".")):
                continue
            if commit not in commits:
                lost.append(commit)
                continue
            inside = (f"{commit}/{n}" for n in paths.names(self.spark, f"{self.root}/{commit}"))
            lost += [f for f in inside if f"/{BUCKET}=" in f and f not in kept]
        lost += [f"{INCOMING}/{n}" for n in paths.names(self.spark, f"{self.root}/{INCOMING}")]
        for name in lost:
            paths.delete(self.spark, f"{self.root}/{name}")
        return lost
