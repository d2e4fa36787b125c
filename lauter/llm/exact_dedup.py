"""Exact deduplication over an extendible-hash index on shared files.

1. Equal texts meet: one index entry per distinct normalised text. Copies are combined in
   the tasks that read them, before any shuffle, and entries are told apart by their
   bytes, so texts whose hash is the same stay apart (a chain below one hash).
2. The directory: entries are counted by the leading bits of their hash. It starts with
   one bucket, and a bucket with more than ``capacity`` entries is split by one more bit,
   doubling the directory where needed, to at most ``max_depth`` bits.
3. Entries are dealt to owner tasks by ranges of buckets and written as sorted Parquet
   files to the shared folder.
4. Every row looks its bucket up in the directory and its entry up in the bucket.

Everything is DataFrame functions. Rows of a hot text are spread over tasks at all times:
step 1 sends one row per task and text, and the lookup joins against one row per entry, of
which adaptive execution splits the hot side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lauter.llm.common import ascii_lower, text_or_empty, written

CAPACITY = 16_384
MAX_DEPTH = 14


def prefix_of(hash64: Column, depth: int) -> Column:
    """The leading ``depth`` bits as a number from 0."""
    return F.shiftrightunsigned(hash64, 64 - depth)


def directory_of(entries: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """``prefix, depth, bucket`` for each used prefix of ``max_depth`` bits.

    ``depth`` is the local depth of the bucket, ``bucket`` its first prefix, so buckets
    are disjoint ranges in hash order. At most ``2 ** max_depth`` rows.
    """
    cells = entries.groupBy(prefix_of(F.col("h"), max_depth).alias("prefix")).agg(
        F.count("*").alias("n")
    )
    levels = cells.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(max_depth - 1))))
    levels = levels.withColumn("node", F.expr(f"shiftright(prefix, {max_depth} - d)"))
    overfull = levels.groupBy("d", "node").agg(F.sum("n").alias("held"))
    overfull = overfull.where(F.col("held") > capacity)
    depths = (
        levels.join(overfull, ["d", "node"], "left")
        .groupBy("prefix")
        .agg(F.max(F.when(F.col("held").isNotNull(), F.col("d") + 1).otherwise(0)).alias("depth"))
    )
    return depths.withColumn(
        "bucket",
        F.expr(f"shiftleft(shiftright(prefix, {max_depth} - depth), {max_depth} - depth)"),
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    hash_of: Callable[[Column], Column] = F.xxhash64,
    capacity: int = CAPACITY,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, bucket``, one row per input row.

    Texts are equal when they are the same after lower-casing A to Z. The row with the
    largest id stays; a null id is smaller than any other. Null text counts as empty.
    Repeated rows (same id, equal text) count in ``group_size``, and exactly one of them
    is ``kept``. Other columns of the input are not read; an empty table gives no rows.
    """
    text = ascii_lower(text_or_empty(F.col(text_col)))
    raw = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    keyed = raw.select("doc_id", "t", hash_of(F.col("t")).cast("long").alias("h"))
    # one entry per text: grouping compares the bytes
    entries = keyed.groupBy("h", "t").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    entries = written(
        entries.select("h", F.sha2("t", 256).alias("sha"), "keep_id", "group_size"), "entries"
    )
    directory = written(directory_of(entries, capacity, max_depth), "directory")
    prefix = prefix_of(F.col("h"), max_depth)
    # at most 2 ** max_depth rows of three numbers
    placed = entries.withColumn("prefix", prefix).join(F.broadcast(directory), "prefix")
    index = written(
        placed.drop("prefix", "depth")
        .repartitionByRange("bucket", "h", "sha")
        .sortWithinPartitions("bucket", "h", "sha"),
        "index",
    )
    rows = written(keyed.select("doc_id", "h", F.sha2("t", 256).alias("sha")), "rows")
    rows = rows.withColumn("prefix", prefix).join(F.broadcast(directory), "prefix").drop("prefix", "depth")
    # the chain below one hash is told apart by the digest of the compared bytes
    found = rows.join(index, ["bucket", "h", "sha"])
    last = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    found = found.withColumn("kept", last)
    return _one_kept(found).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"), "bucket"
    )


def _one_kept(found: DataFrame) -> DataFrame:
    """Of repeated rows that would all stay, let the first stay.

    Only the rows that would stay are numbered; there is one per text but for repeats.
    """
    stays = found.where("kept")
    repeats = stays.groupBy("h", "sha").agg(F.count("*").alias("same")).where("same > 1")
    marked = found.join(repeats, ["h", "sha"], "left").withColumn(
        "again", F.col("kept") & F.col("same").isNotNull()
    )
    number = F.row_number().over(Window.partitionBy("h", "sha", "doc_id").orderBy("h"))
    tied = marked.where("again").withColumn("kept", number == 1)
    return marked.where("NOT again").unionByName(tied)


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = exact_dedup(docs, id_col, text_col)
    kept = decided.where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")
    )
    sha = F.sha2(ascii_lower(text_or_empty(F.col(text_col))), 256)
    named = docs.withColumn("__sha", sha).withColumn("__id", F.col(id_col))
    same = named["__id"].eqNullSafe(kept["__id"]) & (named["__sha"] == kept["__sha"])
    # a row repeated as a whole stays once
    left = named.join(kept, same, "left_semi")
    repeats = left.groupBy("__id", "__sha").agg(F.count("*").alias("__same")).where("__same > 1")
    pair = left["__id"].eqNullSafe(repeats["__id"]) & (left["__sha"] == repeats["__sha"])
    once = left.join(repeats, pair, "left_anti")
    tied = left.join(repeats, pair, "left_semi").dropDuplicates(["__id", "__sha"])
    return once.unionByName(tied).drop("__id", "__sha")
