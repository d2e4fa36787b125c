"""Deterministic deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lauter.operators.rules import ENTITIES, POSITION, accepted


def first_per_key(df: DataFrame, key: str, order: str = POSITION) -> DataFrame:
    """The earliest row of every key.

    Catalyst turns the filter into a per-partition group limit ahead of the
    shuffle, so each task sends at most one row per key however hot the key is.
    """
    ranked = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def first_valid(classified: DataFrame, entity: str) -> DataFrame:
    """The first accepted record per entity key; rejected ones never block a key."""
    return first_per_key(accepted(classified), ENTITIES[entity].key)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values of a raw column."""
    return df.select(column).where(F.col(column) != "").distinct()
