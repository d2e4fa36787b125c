"""CSV and Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lauter.operators.rules import POSITION


def with_position(df: DataFrame) -> DataFrame:
    """Add ``_pos`` to a frame read from files: file, split, and row in reading order.

    Rows keep their place even if the frame is repartitioned afterwards. In a
    stream the row number is left to the micro-batch.
    """
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    if not df.isStreaming:
        place.append(F.monotonically_increasing_id())
    return df.select(*df.columns, F.struct(*place).alias(POSITION))


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    delimiter: str = ",",
    encoding: str = "UTF-8",
    multiline: bool = True,
) -> DataFrame:
    """A header CSV with every column a string; a BOM is dropped.

    A field may span lines, so each file is parsed by one task. With
    ``multiline=False`` every line is a row of its own and large files are split; lines
    of white space alone are then no rows. The files of a folder must have the same
    header; another one fails the job.
    """
    return with_position(
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("sep", delimiter)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Typed rows; only ``columns`` are read from disk."""
    df = spark.read.parquet(path)
    chosen = df.columns if columns is None else list(columns)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df.select(*chosen, place.alias(POSITION))
