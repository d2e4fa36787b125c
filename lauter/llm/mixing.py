"""Mixing sources to target weights by fitting each source's budget as a subset sum.

Documents are counted by their exact length, per source. A source's budget is met in
three steps: whole copies of everything, the same share of every length (rounded down),
and a bounded-knapsack dynamic programme over the lengths left for what remains. Where
that misses the budget, a smaller share is fixed and the programme has more to fill. The
result is a number of documents per length; which ones is decided by a seeded hash.

One task sees one row per length of a source, never its documents. The documents of one
length, which may be a third of all rows, are never gathered: a hash bucket decides for
nearly all of them, and only the bucket at the threshold is ranked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lauter.llm.common import text_or_empty, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20_240_229
EXACT = 65_536
BUCKETS = 4_096


def targets_of(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``target`` for each row of ``source, source_size`` (one row per source).

    Sources take the weights in code-point order, null last. A target stops at ``most``
    times the source's size. Re-sharing the excess until none is above ends at the level
    ``x`` with ``sum(min(most * size, x * weight)) = share * total``; sources stop in the
    order of size / weight, so ``x`` follows from running sums.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    cap = F.lit(most) * F.col("source_size")
    ranked = sources.select("source", "source_size", weight.cast("double").alias("w"), cap.alias("cap"))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("w"))
    everything = Window.partitionBy()
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    total = F.lit(share) * F.sum("source_size").over(everything)
    ranked = (
        ranked.withColumn("total", total)
        .withColumn("capped", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("free", F.sum("w").over(everything) - F.sum("w").over(upto) + F.col("w"))
    )
    # with the sources before this one stopped; it rises until the first that needs no stop
    level = (F.col("total") - F.col("capped")) / F.col("free")
    level = F.max(level).over(everything)
    return ranked.select(
        "source", "source_size", F.least(F.col("cap"), level * F.col("w")).cast("double").alias("target")
    )


def fit(sizes: np.ndarray, counts: np.ndarray, budget: float, exact: int = EXACT) -> np.ndarray:
    """How many documents of each size to take for a sum near ``budget``.

    The same share of all sizes first, then the bounded knapsack for what remains. If the
    budget is not met, the share leaves more to the knapsack, up to ``exact`` words: for
    budgets up to that no sum is nearer.
    """
    best = np.zeros(len(sizes), dtype=np.int64)
    whole = int((sizes * counts).sum())
    budget = int(round(min(budget, whole)))
    if budget <= 0:
        return best
    if budget == whole:
        return counts.astype(np.int64)
    missed = budget
    for band in (0, exact // 64, exact // 16, exact // 4, exact):
        taken = _share(sizes, counts, max(budget - band, 0), whole, budget, exact)
        taken = taken + knapsack(sizes, counts - taken, budget - int((taken * sizes).sum()))
        off = abs(budget - int((taken * sizes).sum()))
        if off < missed:
            best, missed = taken, off
        if not missed or band >= budget:
            break
    return best


def _share(sizes: np.ndarray, counts: np.ndarray, part: int, whole: int, budget: int, exact: int) -> np.ndarray:
    """The share ``part / whole`` of all sizes, and more, large to small, while above ``exact`` is missing."""
    taken = np.minimum((counts * (part / whole)).astype(np.int64), counts)
    left = budget - int((taken * sizes).sum())
    for i in np.argsort(-sizes, kind="stable"):
        if left <= exact:
            break
        if sizes[i]:
            more = min(int(counts[i] - taken[i]), (left - exact // 2) // int(sizes[i]))
            if more > 0:
                taken[i] += more
                left -= more * int(sizes[i])
    return taken


def knapsack(sizes: np.ndarray, spare: np.ndarray, goal: int) -> np.ndarray:
    """Counts up to ``spare`` whose sum is as near to ``goal`` as any sum can be.

    Each size is split into 1, 2, 4, ... copies, so that any number up to the spare one
    can be put together; ``by`` keeps the piece that first reached a sum.
    """
    use = np.zeros(len(sizes), dtype=np.int64)
    if goal <= 0:
        return use
    limit = 2 * goal  # nothing above is nearer than taking none
    reach = np.zeros(limit + 1, dtype=bool)
    reach[0] = True
    by = np.full(limit + 1, -1, dtype=np.int64)
    pieces: list[tuple[int, int]] = []
    for i in np.argsort(sizes, kind="stable"):
        size, n, step = int(sizes[i]), int(spare[i]), 1
        n = min(n, limit // size) if size else 0
        while n > 0 and not reach[goal]:
            step = min(step, n)
            jump = step * size
            new = np.flatnonzero(reach[:-jump] & ~reach[jump:]) + jump if jump <= limit else []
            if len(new):
                reach[new] = True
                by[new] = len(pieces)
            pieces.append((int(i), step))
            n -= step
            step *= 2
        if reach[goal]:
            break
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    while at:
        i, step = pieces[by[at]]
        use[i] += step
        at -= step * int(sizes[i])
    return use


_PLAN = "source string, source_size long, target double, size long, n long, base long, extra long"


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    whole, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    base = min(int(target // whole), MOST) if whole else 0
    rest = target - base * whole if base < MOST else 0.0
    group = group.sort_values("size")
    extra = fit(group["size"].to_numpy(), group["n"].to_numpy(), rest)
    return group.assign(base=base, extra=extra)[[c.split()[0] for c in _PLAN.split(", ")]]


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    seed: int = SEED, carry: bool = False,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, copies``, one row per input row.

    With ``carry`` also ``row``, the whole input row as a struct.

    Size is the number of runs of non-space characters, 0 for null text. Each document is
    taken 0, 1 or 2 times; documents of size 0 add nothing either way. Null is a source of
    its own. Which documents are taken depends on ``seed`` and the id alone, so reruns
    agree; repeated rows have equal chances. An empty table gives no rows.
    """
    size = F.regexp_count(text_or_empty(F.col(text_col)), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    whole_row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), *whole_row
        ),
        "sizes",
    )
    lengths = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    whole = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = targets_of(whole).withColumnRenamed("source", "s")
    planned = lengths.join(targets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = written(planned.groupBy("source").applyInPandas(_plan, _PLAN), "plan")

    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    keyed = rows.withColumn("order", order).withColumn("bucket", F.shiftrightunsigned("order", 52))
    p = plan.withColumnRenamed("source", "s").withColumnRenamed("size", "z")
    keyed = keyed.join(p, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    cells = keyed.where(some).groupBy("source", "size", "bucket", "extra").agg(F.count("*").alias("held"))
    upto = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("before", F.sum("held").over(upto) - F.col("held"))
    edges = cells.where((F.col("before") < F.col("extra")) & (F.col("before") + F.col("held") >= F.col("extra")))
    edges = edges.select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("bucket").alias("edge"),
        (F.col("extra") - F.col("before")).alias("short"),
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    edged = keyed.join(edges, same, "left").drop("s", "z")
    # a bucket is 1 / 4096 of the documents of one length
    at_edge = edged.where("bucket = edge")
    rank = F.row_number().over(Window.partitionBy("source", "size").orderBy("order", "doc_id"))
    at_edge = at_edge.withColumn("more", (rank <= F.col("short")).cast("long"))
    clear = edged.where("edge IS NULL OR bucket <> edge").withColumn(
        "more",
        F.when(F.col("edge").isNull(), F.col("extra") >= F.col("n")).otherwise(F.col("bucket") < F.col("edge")).cast("long"),
    )
    chosen = clear.unionByName(at_edge)
    copies = F.col("base") + F.col("more")
    return chosen.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"),
        *(["row"] if carry else []),
    )


_MIXED = ("size", "source_size", "target", "taken", "copies")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with their columns and those of the mix.

    ``copies`` says how often a row is taken. Columns named as those of the mix give way.
    """
    own = [c for c in docs.columns if c not in _MIXED]
    taken = mix(docs, id_col, text_col, source_col, seed=seed, carry=True).where("copies > 0")
    return taken.select(*(F.col("row").getField(c).alias(c) for c in own), *_MIXED)
