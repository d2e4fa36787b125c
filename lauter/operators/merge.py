"""Keyed upsert as a grouping (K2) and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id() keeps the partition in the bits above these
PARTITION_SHIFT = 33
ROW_NUMBER = "_mid"
LOADED, NEW_KEY = "_loaded", "_new_key"
# some 32 MB broadcast
MOST_OFFSETS = 1 << 20


def number_rows(staged: DataFrame, base: int, out: str = "id") -> DataFrame:
    """Distinct ids above ``base`` from the ``_mid`` written with a staged frame.

    ``_mid`` holds (task, row in task). The rows of each task get consecutive
    ids after those of the tasks before it. The offsets have two numbers per task of
    the job that wrote ``staged``; they are added up on the driver, so that their number is
    known: up to ``MOST_OFFSETS`` they are broadcast, more are joined by a shuffle.
    """
    task = F.shiftrightunsigned(F.col(ROW_NUMBER), PARTITION_SHIFT)
    index = F.col(ROW_NUMBER).bitwiseAND((1 << PARTITION_SHIFT) - 1)
    sizes = staged.groupBy(task.alias("_task")).agg((F.max(index) + 1).alias("_size")).collect()
    offsets, total = [], base
    for number, size in sorted(map(tuple, sizes)):
        offsets.append((number, total))
        total += size
    if len(offsets) <= 1:
        return staged.withColumn(out, F.lit(base) + index + 1).drop(ROW_NUMBER)
    before = staged.sparkSession.createDataFrame(offsets, "_task bigint, _before bigint")
    if len(offsets) <= MOST_OFFSETS:
        before = F.broadcast(before)
    numbered = staged.withColumn("_task", task).join(before, "_task")
    return numbered.withColumn(out, F.col("_before") + index + 1).drop("_task", "_before", ROW_NUMBER)


def merge_rows(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: Sequence[str],
    updates: Sequence[str],
    sticky: Sequence[str] = (),
    *,
    within: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Insert-or-update: every existing row, changed where ``incoming`` has its key,
    plus the incoming rows with new keys.

    Both sides are unique on ``key``. ``id`` and ``created_at`` of existing rows
    survive; ``sticky`` columns keep the old value when the new one is NULL. The
    result has the columns of ``incoming``, ``_loaded`` (row came from ``incoming``) and
    ``_new_key``. Both sides are laid on top of each other and grouped: one shuffle of
    each row, by ``within`` if given (a column that follows from the key), else by the key,
    and rows in the order of (``within``, key).
    """
    columns = incoming.columns
    row = F.struct(*columns)
    group = [*([within] if within else []), *key]
    none = F.lit(None).cast(incoming.select(row.alias("r")).schema["r"].dataType)
    both = incoming.select(*group, none.alias("_old"), row.alias("_new"))
    if existing is not None:
        both = existing.select(*columns).select(*group, row.alias("_old"), none.alias("_new")).unionAll(both)
    if within:
        both = both.repartition(tasks, within) if tasks else both.repartition(within)
    merged = both.groupBy(*group).agg(
        F.first("_old", ignorenulls=True).alias("_old"), F.first("_new", ignorenulls=True).alias("_new")
    )
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str):
        before, after = F.col("_old")[name], F.col("_new")[name]
        if name in group:
            return F.col(name)
        if name in sticky:
            return F.coalesce(after, before).alias(name)
        if name in updates:
            return F.when(has, after).otherwise(before).alias(name)
        return F.when(had, before).otherwise(after).alias(name)

    return merged.select(*[value(c) for c in columns], has.alias(LOADED), (has & ~had).alias(NEW_KEY))
