"""Run audit queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
RUN_BUCKETS = (1, 5, 10, 30, 60, 120, 300, 600)
BATCH_BUCKETS = (0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0, 30.0)
PAGE_DEFAULT, PAGE_MAX = 20, 100
# ----------------------------------------------------------------------------


def duration_seconds() -> Column:
    """Length of a run with fractions, NULL while unfinished."""
    micros = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("finished_at"))
    return micros / 1e6


def run_summaries(runs: DataFrame) -> DataFrame:
    return runs.drop("error_log").withColumn("duration_seconds", duration_seconds())


def _newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("id"))


def latest_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """The newest runs."""
    return _newest_first(run_summaries(runs)).limit(limit)


def runs_page(runs: DataFrame, limit: int = PAGE_DEFAULT, offset: int = 0) -> DataFrame:
    """One page of runs, newest first."""
    if not 1 <= limit <= PAGE_MAX:
        raise ValueError(f"limit must be between 1 and {PAGE_MAX}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return _newest_first(run_summaries(runs)).offset(offset).limit(limit)


def run_by_id(runs: DataFrame, run_id: int) -> DataFrame:
    """One run with its error log, or no row."""
    return runs.where(F.col("id") == run_id).withColumn("duration_seconds", duration_seconds())


def reason_counts(rejects: DataFrame, reason: Column, *by: str) -> DataFrame:
    """``reason, rows`` per group; map-side combined."""
    return rejects.groupBy(*by, reason.alias("reason")).agg(F.count("*").alias("rows"))


def _error_line() -> Column:
    repeated = F.concat("reason", F.lit(" (x"), F.col("rows").cast("string"), F.lit(")"))
    return F.when(F.col("rows") == 1, F.col("reason")).otherwise(repeated)


def error_log(rejects: DataFrame, reason: Column, *by: str) -> DataFrame:
    """One error text per group (A12): a line per distinct reason with its count.

    Reasons carry no record values, so a group has at most as many lines as the
    rules can produce, whatever the number of rejected rows; each record's full
    reason is in the dead letters.
    """
    lines = reason_counts(rejects, reason, *by).withColumn("line", _error_line())
    return lines.groupBy(*by).agg(
        F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("error_log"),
        F.sum("rows").alias("rows_failed"),
    )


def error_lines(rejects: DataFrame, reason: Column) -> list[str]:
    """The lines of :func:`error_log` for one run."""
    lines = reason_counts(rejects, reason).select(_error_line().alias("line"))
    return sorted(row["line"] for row in lines.collect())


def counters(df: DataFrame, labels: Sequence[str], measure: str, out: str) -> DataFrame:
    """A counter per label combination: the sum of ``measure``."""
    return df.groupBy(*labels).agg(F.sum(measure).alias(out))


def reason_category(reason: str = "reason") -> Column:
    """The part of a reason before its first colon, without repeats of details."""
    return F.substring_index(F.col(reason), ":", 1)


def duration_histogram(
    runs: DataFrame, by: Sequence[str] = ("source",), buckets: Sequence[float] = RUN_BUCKETS
) -> DataFrame:
    """Cumulative ``le`` buckets of the durations of finished runs.

    One aggregation over the runs; the buckets become rows afterwards.
    """
    timed = runs.withColumn("_seconds", duration_seconds()).where("_seconds IS NOT NULL")
    totals = timed.groupBy(*by).agg(
        *[F.count_if(F.col("_seconds") <= le).alias(f"b{i}") for i, le in enumerate(buckets)],
        F.count("*").alias("all"),
    )
    bars = [
        F.struct(F.lit(str(le)).alias("le"), F.col(f"b{i}").alias("runs"))
        for i, le in enumerate(buckets)
    ]
    bars.append(F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("runs")))
    return totals.select(*by, F.inline(F.array(*bars)))
