"""Benchmark decontamination with one Aho-Corasick automaton.

The automaton holds every window of 13 consecutive words of every benchmark item (an item
of fewer words is one window) as a sequence of word numbers. A document is turned into
words and read through the automaton once; windows it contains mark words, and marked
words map back to offsets of the original text.

The automaton of one block of the benchmark, at most ``BLOCK_WORDS`` words, is built once
per task. A benchmark of more words is taken in blocks, one pass over the documents each,
every row carrying its marks along; so memory is bounded whatever the benchmark's size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lauter.llm.common import text_or_empty, written

WINDOW = 13
BLOCK_WORDS = 500_000

_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"


def _normal_bytes() -> bytes:
    """A-Z to a-z; other ASCII that is neither digit nor letter to a space."""
    table = bytearray(range(256))
    for code in range(128):
        low = bytes([code]).lower()
        table[code] = low[0] if low in _LETTERS else 0x20
    return bytes(table)


NORMAL = _normal_bytes()
# the same words with their places in a string
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Windows of benchmark items, and a scan for them."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                windows.setdefault(tuple(ids[start : start + window]), set()).add(item)
        self.shortest = min(map(len, windows), default=0)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, owners in windows.items():
            self.machine.add_word(ids, (len(ids), owners))
        if windows:
            self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged ranges of marked words and the items with occurring windows."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        ids = tuple(map(self.numbers.get, words, repeat(0)))
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        for end, (length, owners) in self.machine.iter(ids):
            start, stop = end + 1 - length, end + 1
            items |= owners
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append((start, stop))
        return ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


_RANGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
_MARKS = [
    T.StructField("__ranges", T.ArrayType(_RANGE)),
    T.StructField("__items", T.ArrayType(T.StringType())),
    T.StructField("__words", T.LongType()),
]
_MARKS_ARROW = [
    pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
    pa.list_(pa.string()),
    pa.int64(),
]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> list[list]:
    """Items in blocks of bounded size; one item longer than a block is a block."""
    named = benchmark.select(
        F.col(id_col).cast("string").alias("item"), text_or_empty(F.col(text_col)).alias("text")
    ).where("item IS NOT NULL").distinct()
    blocks: list[list] = [[]]
    held = 0
    for row in named.toLocalIterator():
        size = len(words_of(row["text"].encode()))
        if blocks[-1] and held + size > block_words:
            blocks.append([])
            held = 0
        blocks[-1].append((row["item"], row["text"].encode()))
        held += size
    return blocks


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    *,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with all its columns and ``__ranges`` (word ranges), ``__items``, ``__words``."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in _MARKS]
    frame = docs.select("*", *empty)
    schema = T.StructType([*docs.schema.fields, *_MARKS])
    blocks = _blocks(benchmark, item_id, item_text, block_words)
    for number, items in enumerate(blocks):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(held.value, window)
            for batch in batches:
                where = {n: i for i, n in enumerate(batch.schema.names)}
                texts = batch.column(where[text_col]).cast(pa.binary())
                before = batch.column(where["__ranges"]), batch.column(where["__items"])
                ranges, found, counts = [], [], []
                for i, text in enumerate(texts):
                    words = words_of(text.as_py() or b"")
                    here, items = automaton.scan(words)
                    old = before[0][i].as_py()
                    if old:
                        here = merged([(r["start"], r["stop"]) for r in old] + here)
                        items |= set(before[1][i].as_py())
                    ranges.append([{"start": a, "stop": b} for a, b in here])
                    found.append(sorted(items))
                    counts.append(len(words))
                columns = list(batch.columns)
                for name, values, kind in zip(
                    ("__ranges", "__items", "__words"), (ranges, found, counts), _MARKS_ARROW, strict=True
                ):
                    columns[where[name]] = pa.array(values, kind)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        frame = frame.mapInArrow(scan, schema)
        if number + 1 < len(blocks):
            frame = written(frame, "marks")
    return frame


N_HIT = "aggregate(__ranges, 0L, (n, r) -> n + r.stop - r.start)"
CONTAMINATED = f"({N_HIT} > 0 AND 20 * {N_HIT} >= __words)"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated, spans``, one row per input row.

    ``spans`` are [start, stop) code points of the original text, one per run of marked
    words. Null text has no words. Items with null id, null or wordless text have no
    windows; repeated items count once. With an empty benchmark nothing is marked.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = mark(plain, benchmark)

    @F.pandas_udf("array<struct<start:long,stop:long>>")
    def places(texts, ranges):
        out = []
        for text, own in zip(texts, ranges, strict=True):
            spans = []
            if len(own):
                at = [(m.start(), m.end()) for m in WORD.finditer(text)]
                spans = [{"start": at[r["start"]][0], "stop": at[r["stop"] - 1][1]} for r in own]
            out.append(spans)
        import pandas

        return pandas.Series(out)

    return marked.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        F.expr(N_HIT).alias("n_hit"),
        F.col("__items").alias("items"),
        F.expr(CONTAMINATED).alias("contaminated"),
        places(F.when(F.size("__ranges") > 0, F.col("text")), "__ranges").alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    return mark(docs, benchmark).where(f"NOT {CONTAMINATED}").select(*docs.columns)
