"""Audit of how far the sources of a language differ in their words.

1. Counting, in numpy on slices of the UTF-8 bytes. Terms are bucketed by length: up to 8
   bytes a term is one 64-bit word, up to 16 bytes two, zero bytes behind its end (no term
   holds one), and each bucket is put in order by radix passes over the 16-bit digits its
   lengths can reach. Longer terms lie in buckets of 32, 64, ... bytes, each sorted as
   bytes. Runs of equal (group, term) then give occurrences and documents, so a slice sends
   every term of a source once, however frequent.
2. Spark adds up the slices, keeps the terms of at least ``keep`` documents of a language
   and lays the counts of a kept term beside each other, one short list per term.
3. All values are whole numbers. Two sources a and b are compared over *all* kept terms of
   the language without visiting the terms that neither or only one of them has:

       sum f = V f00 + sum over a's terms of (f(p, q0) - f00)
                     + sum over b's terms of (f(p0, q) - f00)
                     + sum over common terms of (f(p, q) - f(p, q0) - f(p0, q) + f00)

   where p0, q0 are the shares of an absent term. The second and third sum depend on how
   many terms of a source occur how often, a short table per source; only the last needs
   the terms themselves, in numpy, a bounded number of pairs at a time.

Null language, source or text counts as ''. Rows that repeat count as documents of their own.
An empty table gives no rows; a language without kept terms gives value 0 for every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lauter.llm.common import text_or_empty, written

KEEP = 3
TOP = 200
SCALE_STEPS = 3  # the share is counted in 1000 ** 3
SLICE = 8 << 20
PAIRS = 1 << 20
# sources of one language in the code of a pair
_BITS = 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# term bytes: ASCII letters and every byte of a longer character
_TERM = np.zeros(256, dtype=bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
# the first n bytes of a big-endian word
_FIRST = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], dtype=np.uint64)


# -- counting -----------------------------------------------------------------


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every term; ``offsets`` has an end behind the last."""
    inside = _TERM[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - start
    return start, length, np.searchsorted(offsets, start, side="right") - 1


def _radix(order: np.ndarray, key: np.ndarray, low: int, high: int) -> np.ndarray:
    """``order`` put in the order of the 16-bit digits of ``key`` from ``low`` to ``high``."""
    for shift in range(low, high, 16):
        digit = ((key >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)[order]
        if digit.min() != digit.max():
            order = order[np.argsort(digit, kind="stable")]
    return order


def _words(padded: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each start as one big-endian word, zeros behind the end."""
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[start]
    return eight.view(">u8")[:, 0].astype(np.uint64) & _FIRST[np.clip(length, 0, 8)]


def term_runs(data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray, text: np.ndarray):
    """``(start, length, group, n, texts)`` of every distinct term of a group, by bucket.

    ``data`` is lower-cased; occurrences come in the order of their texts, which the stable
    passes keep within a run.
    """
    digits = np.where(length <= 16, (length + 1) // 2, 0)
    widths = np.where(length <= 16, 0, np.ceil(np.log2(np.maximum(length, 2))).astype(np.int64))
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    for width, count in sorted(set(zip(widths.tolist(), digits.tolist(), strict=True))):
        chosen = np.flatnonzero((widths == width) & (digits == count))
        s, n = start[chosen], length[chosen]
        g = group[chosen].astype(np.uint64)
        order = np.arange(len(chosen))
        if width:
            size = 1 << width
            room = np.concatenate([data, np.zeros(size, np.uint8)])
            keys = np.lib.stride_tricks.sliding_window_view(room, size)[s] * (np.arange(size) < n[:, None])
            columns = [keys.astype(np.uint8).view(f"S{size}")[:, 0]]
            order = np.argsort(columns[0], kind="stable")
        elif count <= 4:
            columns = [_words(padded, s, n)]
            order = _radix(order, columns[0], 64 - 16 * count, 64)
        else:
            columns = [_words(padded, s, n), _words(padded, s + 8, n - 8)]
            order = _radix(order, columns[1], 128 - 16 * count, 64)
            order = _radix(order, columns[0], 0, 64)
        order = _radix(order, g, 0, 64)
        new = np.zeros(len(order), dtype=bool)
        new[0] = True
        for column in (*columns, g):
            ordered = column[order]
            new[1:] |= ordered[1:] != ordered[:-1]
        other = new.copy()
        numbers = text[chosen][order]
        other[1:] |= numbers[1:] != numbers[:-1]
        heads = np.flatnonzero(new)
        first = chosen[order[heads]]
        yield (
            start[first], length[first], group[first],
            np.diff(np.append(heads, len(order))), np.add.reduceat(other.astype(np.int64), heads),
        )


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.cumsum(length)
    flat = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    held = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[flat]))
    return held.cast(pa.string())


_COUNTED = "lang string, source string, term string, n long, docs long"
_NAMES = ["lang", "source", "term", "n", "docs"]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have at most ``SLICE`` bytes together; a longer text alone."""
    sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + SLICE, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array without nulls, lower-cased, and the offsets of its texts."""
    large = texts.cast(pa.large_string())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    held = large.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.empty(0, np.uint8)
    return _LOWER[data], offsets - offsets[0]


def _long_text(data: np.ndarray) -> dict[bytes, int]:
    """Counts of one text too long for a slice, window by window; windows end between terms."""
    counts: dict[bytes, int] = {}
    at = 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and _TERM[data[end - 1]] and _TERM[data[end]]:
            gap = np.flatnonzero(~_TERM[data[end : end + SLICE]])
            end = end + int(gap[0]) if len(gap) else end + SLICE
        window = data[at : min(end, len(data))]
        start, length, text = term_spans(window, np.array([0, len(window)]))
        for s, n, _, times, _ in term_runs(window, start, length, text, text):
            for a, b, c in zip(s.tolist(), n.tolist(), times.tolist(), strict=True):
                term = window[a : a + b].tobytes()
                counts[term] = counts.get(term, 0) + c
        at = end
    return counts


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in _slices(batch):
            data, offsets = _buffer(rows["text"])
            if rows.num_rows == 1 and len(data) > SLICE:
                counts = _long_text(data)
                terms = [t.decode("utf-8") for t in counts]
                one = [pa.array([rows[c][0].as_py()] * len(terms), pa.string()) for c in ("lang", "source")]
                numbers = [pa.array(list(counts.values()), pa.int64()), pa.array([1] * len(terms), pa.int64())]
                yield pa.RecordBatch.from_arrays([*one, pa.array(terms, pa.string()), *numbers], names=_NAMES)
                continue
            start, length, text = term_spans(data, offsets)
            if not len(start):
                continue
            lang, source = (rows[c].dictionary_encode() for c in ("lang", "source"))
            code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            for s, n, g, times, texts in term_runs(data, start, length, code[text], text):
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(g // len(source.dictionary))),
                        source.dictionary.take(pa.array(g % len(source.dictionary))),
                        _strings(data, s, n), pa.array(times, pa.int64()), pa.array(texts, pa.int64()),
                    ],
                    names=_NAMES,
                )


# -- comparing ----------------------------------------------------------------


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10**9 (count + 1) / (total + terms))`` by long division, three digits at a
    time, so that nothing exceeds 64 bits below 9e15 words; null without terms."""
    whole, rest = total + terms, count + F.lit(1)
    found = F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        found = found * 1000 + _div(rest, whole)
        rest = rest % whole
    return F.when(terms > 0, found + 1)


def _div(left: Column, right: Column) -> Column:
    return F.call_function("div", left, right)


def surprise(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def common_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the common terms of two sources add, summed up per chunk of pairs.

    A chunk has at most ``PAIRS`` pairs and one more term's; sums of a chunk stay below
    8e18, as the shares of a source add up to about 10**9.
    """
    for batch in batches:
        lang = batch["lang"].dictionary_encode()
        lists = batch["by"]
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        a, p, absent = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
        if len(a) and a.max() >> _BITS:
            raise ValueError("too many sources in one language")
        ends = np.cumsum(sizes)
        partners = np.repeat(sizes, sizes)
        first = np.repeat(ends - sizes, sizes)
        langs = np.repeat(lang.indices.to_numpy().astype(np.int64), sizes)
        done = np.concatenate([[0], np.cumsum(partners)])
        at = 0
        while at < len(a):
            stop = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
            k = partners[at:stop]
            left = np.repeat(np.arange(at, stop), k)
            right = np.repeat(first[at:stop] - (done[at:stop] - done[at]), k) + np.arange(len(left))
            keep = left != right
            left, right = left[keep], right[keep]
            at = stop
            if not len(left):
                continue
            value = np.zeros(len(left), np.int64)
            for x, y, sign in ((p, p, 1), (p, absent, -1), (absent, p, -1), (absent, absent, 1)):
                gap = x[left] - y[right]
                value += sign * (gap * gap // y[right])
            code = (langs[left] << 2 * _BITS) | (a[left] << _BITS) | a[right]
            order = np.argsort(code, kind="stable")
            code = code[order]
            heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            code = code[heads]
            mask = (1 << _BITS) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(code >> 2 * _BITS)),
                    pa.array((code >> _BITS) & mask, pa.int64()), pa.array(code & mask, pa.int64()),
                    pa.array(np.add.reduceat(value[order], heads), pa.int64()),
                ],
                names=["lang", "a", "b", "value"],
            )


def term_counts(docs: DataFrame, lang_col="lang", source_col="source", text_col="text") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of a term and documents that hold it."""
    columns = {"lang": lang_col, "source": source_col, "text": text_col}
    plain = docs.select(*[text_or_empty(F.col(f"`{c}`")).alias(name) for name, c in columns.items()])
    found = plain.mapInArrow(count_terms, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    *,
    keep: int = KEEP,
    top: int = TOP,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair`` compares a source with every other one of its language, part ``term`` has
    the ``top`` terms that a source uses most in excess of its language. Value descending,
    then item in UTF-8 order.
    """
    counts = term_counts(docs, lang_col, source_col, text_col)
    per_term = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("whole"),
        F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("by"),
    )
    kept = written(per_term.where(F.col("docs") >= keep).drop("docs"), "kept-terms")

    names = [text_or_empty(F.col(f"`{c}`")).alias(n) for n, c in (("lang", lang_col), ("source", source_col))]
    groups = docs.select(*names).distinct()
    entries = kept.select("lang", "term", "whole", F.inline("by"))
    per_source = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = kept.groupBy("lang").agg(F.sum("whole").alias("lang_total"), F.count("*").alias("terms"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    none = F.lit(0).cast("long")
    sides = groups.join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    sides = sides.select(
        "lang", "source", number.alias("no"),
        *[F.coalesce(c, none).alias(c) for c in ("total", "lang_total", "terms")],
    ).withColumn("absent", share(none, F.col("total"), F.col("terms")))
    # written, so that its size is known: small tables of sources are broadcast, others not
    sides = written(sides, "sources")

    shares = entries.join(sides, ["lang", "source"]).select(
        "lang", "source", "no", "term", "n", "absent",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("whole"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    over = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        surprise(F.col("p"), F.col("q")).alias("value"),
    )
    terms = _ranked(over).where(F.col("rank") <= top)

    return _ranked(_pairs(sides, shares)).unionByName(terms)


def _pairs(sides: DataFrame, shares: DataFrame) -> DataFrame:
    """Every other source of a language with the sum over all kept terms."""
    a = sides.select("lang", F.col("no").alias("a"), F.col("absent").alias("p0"), "terms")
    b = sides.select("lang", F.col("no").alias("b"), F.col("absent").alias("q0"))
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "q", "q0"))
    neither = surprise(p0, q0)
    every = a.join(b, "lang").where("a <> b")
    parts = [every.select("lang", "a", "b", F.coalesce(_exact(F.col("terms")) * _exact(neither), F.lit(0)).alias("v"))]
    # how many terms of a source have which share
    histogram = shares.groupBy("lang", "no", "p", "absent").agg(F.count("*").alias("n"))
    mine = histogram.select("lang", F.col("no").alias("a"), "p", F.col("absent").alias("p0"), "n")
    only = mine.join(b, "lang").where("a <> b")
    parts.append(only.select("lang", "a", "b", (_exact(F.col("n")) * _exact(surprise(p, q0) - neither)).alias("v")))
    theirs = histogram.select("lang", F.col("no").alias("b"), F.col("p").alias("q"), F.col("absent").alias("q0"), "n")
    only = theirs.join(a, "lang").where("a <> b")
    parts.append(only.select("lang", "a", "b", (_exact(F.col("n")) * _exact(surprise(p0, q) - neither)).alias("v")))
    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct(F.col("no").cast("long").alias("no"), "p", "absent")).alias("by"))
    common = lists.select("lang", "by").mapInArrow(common_terms, "lang string, a long, b long, value long")
    parts.append(common.select("lang", "a", "b", _exact(F.col("value")).alias("v")))

    total = None
    for part in parts:
        part = part.select(
            "lang", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), _exact(F.col("v")).alias("v")
        )
        total = part if total is None else total.unionByName(part)
    summed = total.groupBy("lang", "a", "b").agg(F.sum("v").cast("long").alias("value"))
    left = sides.select("lang", F.col("no").alias("a"), "source")
    right = sides.select("lang", F.col("no").alias("b"), F.col("source").alias("item"))
    named = summed.join(left, ["lang", "a"]).join(right, ["lang", "b"])
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))
