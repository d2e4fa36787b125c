"""Data quality profile of a table (A4-A10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIGH_NULL_RATE = 0.5
LG_SKETCH = 12
# 1.04 / sqrt(2 ** LG_SKETCH)
SKETCH_ERROR = 0.0163


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, total_rows, null_count, distinct_count``, one row per column.

    Values are unpivoted and counted per (column, value) first, so each task
    sends a value once however often it occurs and no column meets in one task;
    the second step adds up the groups.
    """
    values = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    long = values.unpivot([], list(columns), "column", "value")
    per_value = long.groupBy("column", "value").agg(F.count("*").alias("rows"))
    return per_value.groupBy("column").agg(
        F.sum("rows").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias(
            "null_count"
        ),
        F.count("value").alias("distinct_count"),
    )


def column_counts_approx(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same in one aggregation pass with sketched distinct counts."""
    measures = [F.count("*").alias("total")]
    for i, c in enumerate(columns):
        column = F.col(f"`{c}`")
        measures += [
            F.count_if(column.isNull()).alias(f"nulls_{i}"),
            F.approx_count_distinct(column).alias(f"distinct_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("total").alias("total_rows"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"distinct_{i}").alias("distinct_count"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def profile_table(
    df: DataFrame,
    table: str,
    ingested_rows: int,
    columns: Sequence[str] | None = None,
    *,
    approximate: bool = False,
) -> DataFrame:
    """One row per column: counts, rates, percentages and the table's reconciliation.

    ``columns`` defaults to all but ``id``. Rates of an empty table are 0.
    """
    chosen = [c for c in df.columns if c != "id"] if columns is None else list(columns)
    counts = (column_counts_approx if approximate else column_counts)(df, chosen)
    return profile_of_counts(counts, table, ingested_rows, chosen)


def profile_of_counts(
    counts: DataFrame, table: str, ingested_rows: int, columns: Sequence[str]
) -> DataFrame:
    """The profile from ``column, total_rows, null_count, distinct_count``."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(list(enumerate(columns)), "position int, column string")
    filled = wanted.join(counts, "column", "left").na.fill(
        0, ["total_rows", "null_count", "distinct_count"]
    )
    return filled.select(
        F.lit(table).alias("table_name"),
        "position",
        "column",
        "total_rows",
        "null_count",
        "distinct_count",
        _rate("null_count").alias("null_rate"),
        _rate("distinct_count").alias("distinct_rate"),
        F.round(_rate("null_count") * 100, 2).alias("null_rate_pct"),
        F.round(_rate("distinct_count") * 100, 2).alias("distinct_rate_pct"),
        F.lit(ingested_rows).cast("bigint").alias("ingested_rows"),
        (F.col("total_rows") <= ingested_rows).alias("reconciliation_ok"),
    )


def column_sketches(df: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """``column, total_rows, null_count, sketch`` per group of ``by``, in one pass.

    The sketch of a column's distinct values has at most ``2 ** LG_SKETCH`` bytes and can be
    merged with others. Values are compared as text, as :func:`column_counts` does.
    """
    measures = [F.count("*").alias("total")]
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("string")
        measures += [
            F.count_if(value.isNull()).alias(f"nulls_{i}"),
            F.hll_sketch_agg(value, F.lit(LG_SKETCH)).alias(f"sketch_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("total").alias("total_rows"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"sketch_{i}").alias("sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return df.groupBy(*by).agg(*measures).select(*by, F.inline(F.array(*rows)))


def merged_counts(sketches: DataFrame) -> DataFrame:
    """The counts of :func:`column_counts` from sketches of parts of a table.

    Rows and nulls are exact. The standard error of the distinct count is
    ``SKETCH_ERROR`` of it; few values are counted exactly.
    """
    return sketches.groupBy("column").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
    )


def _rate(count: str) -> Column:
    return F.coalesce(F.try_divide(F.col(count), F.col("total_rows")), F.lit(0.0))


def high_null_columns(profile: DataFrame) -> DataFrame:
    """Columns that are NULL in more than half of the rows."""
    return profile.where(F.col("null_rate") > HIGH_NULL_RATE)


def value_distribution(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """``value, rows`` of a categorical column, most frequent first (A10)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    ordered = counts.orderBy(F.desc("rows"), "value")
    return ordered if limit is None else ordered.limit(limit)
