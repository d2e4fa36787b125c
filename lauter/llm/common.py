"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lauter.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame, written to the shared folder with these Parquet options and read again.

    Cuts the lineage: what follows survives lost executors without this work being done
    again, and every later use sees the very same rows.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def written_and_counted(frame: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """As :func:`written`, with these aggregates over the rows, taken by the job that writes them."""
    seen = Observation()
    rows = written(frame.observe(seen, *[c.alias(name) for name, c in counts.items()]), label)
    return rows, seen.get


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-case A to Z only; ``lower`` is many times faster than ``translate`` and the
    same where every character is one byte."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(
        F.translate(column, _UPPER, _UPPER.lower())
    )


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)
