"""Rejected records with their reasons as JSON lines in gzip files (K3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lauter.operators.rules import PROBLEM, RECORD


def dead_letter_rows(rejects: DataFrame, run_id: str, reason: Column) -> DataFrame:
    """``ts, run_id, reason, record``; ``record`` is the raw record itself."""
    # a record too large for one VARIANT is kept as text, and so is what is no JSON value
    text = F.col(RECORD).cast("variant")
    record = F.coalesce(F.try_parse_json(RECORD), text)
    if PROBLEM in rejects.columns:
        record = F.when(F.col(PROBLEM) == "malformed_json", text).otherwise(record)
    return rejects.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ts"),
        F.lit(run_id).alias("run_id"),
        reason.alias("reason"),
        record.alias("record"),
    )


def write_dead_letters(rows: DataFrame, folder: str, run_id: str, batch: str = "0") -> str:
    """One folder per run below ``folder``, one below it per batch; returns the run's.

    Replaying a batch replaces its own lines; other batches of the run add theirs.
    """
    run = f"{folder.rstrip('/')}/run_id={run_id}"
    lines = rows.select(F.to_json(F.struct("ts", "run_id", "reason", "record")).alias("value"))
    # lines repeat names, reasons and the run: as plain text they outgrow the input many times
    lines.write.mode("overwrite").option("compression", "gzip").text(f"{run}/batch={batch}")
    return run
