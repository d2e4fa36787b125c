"""Records from anything that can number them, as a Spark data source.

A producer knows how many records there are now and yields those of a range. Registered
under a name it is read by ``spark.read.format(name)`` with a task for every range, and by
``spark.readStream.format(name)``, where a batch is what came since the last one and the
checkpoint keeps the number reached. A task that is lost is read again from its range.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

RANGE = 100_000


class Producer(ABC):
    """What a user writes: a class made from the options of the reader.

    It is made anew on the driver and in every task, so it must find the same records
    everywhere, and a number must always mean the same record.
    """

    # Spark's DDL of the records
    schema: str

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    @abstractmethod
    def count(self) -> int:
        """The number of records there are now; it may only grow."""

    @abstractmethod
    def records(self, begin: int, end: int) -> Iterator[tuple | pa.RecordBatch]:
        """The records ``begin`` up to ``end``, as rows or as Arrow batches."""


@dataclass
class Range(InputPartition):
    begin: int
    end: int


def _ranges(begin: int, end: int, size: int) -> list[Range]:
    return [Range(at, min(at + size, end)) for at in range(begin, end, size)]


class _Reader(DataSourceReader):
    def __init__(self, producer: Producer, size: int) -> None:
        self.producer, self.size = producer, size

    def partitions(self) -> list[Range]:
        # a source without records is one empty range: no partitions at all are an error
        return _ranges(0, self.producer.count(), self.size) or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[tuple | pa.RecordBatch]:
        yield from self.producer.records(partition.begin, partition.end)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, producer: Producer, size: int) -> None:
        self.producer, self.size = producer, size

    def initialOffset(self) -> dict:
        return {"records": 0}

    def latestOffset(self) -> dict:
        return {"records": self.producer.count()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return _ranges(start["records"], end["records"], self.size)

    def read(self, partition: Range) -> Iterator[tuple | pa.RecordBatch]:
        yield from self.producer.records(partition.begin, partition.end)

    def commit(self, end: dict) -> None:
        """Nothing to let go of: the producer keeps its records."""


def register_producer(spark: SparkSession, name: str, producer: type[Producer]) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read it.

    The option ``rangeSize`` is the number of records a task reads.
    """

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return producer.schema

        def _size(self) -> int:
            return int(self.options.get("rangeSize", RANGE))

        def reader(self, schema) -> DataSourceReader:
            return _Reader(producer(dict(self.options)), self._size())

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _StreamReader(producer(dict(self.options)), self._size())

    spark.dataSource.register(Source)
