"""Files whose records no line end marks, read by many tasks: CSV with line ends inside
fields (S1) and JSON documents (S2).

A text scan cuts a file at every separator byte (the line end, or ``}``) and deals byte
ranges to tasks. Where a range begins inside a quoted field or at some depth of a document
only the bytes before it tell. So it takes two passes, neither of which moves a record:

1. Every range is run through an automaton from each state it may begin in; that gives the
   range's effect, a map of states and a change of depth. Effects are put together in file
   order, one short row per range, and give the true state at every range's beginning.
2. Every range is run again from its true state and cut at true record ends. Records
   within a range leave as they are; what a range holds of a record that crosses its
   borders, at most a head and a tail, is joined with its neighbours' by a grouping of
   those rows alone.

A task takes many small ranges, some ``TASK_BYTES`` of them, one after the other: how many
tasks there are follows from the bytes and the cores, not from how finely files are cut.

The records' texts are then parsed by Spark's own functions, one at a time, so a file may
be of any size; only a single record must fit into a row. Compressed files are one range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lauter.operators.rules import POSITION, RECORD
from lauter.sinks import paths
from lauter.sources.json_records import VARIANT, parse_documents

OUT, IN, BAD = 0, 1, 2
_MASK = (1 << 64) - 1
# what a task reads, of ranges that are smaller
TASK_BYTES = 8 << 20


# -- automata -----------------------------------------------------------------


@dataclass(frozen=True)
class CsvLines:
    """Lines of a CSV. ``OUT``: a record begins with the line; ``IN``: it is inside quotes."""

    delimiter: bytes
    separator: bytes = b"\n"

    quiet = b'"'  # a line without this byte leaves every state as it is

    def step(self, line: bytes, state: int) -> tuple[int, int]:
        """The state behind the line. A quote opens a field only at its beginning; text
        between a closing quote and the next delimiter is ``BAD``."""
        at, end, gap = 0, len(line), len(self.delimiter)
        inside = state == IN
        while state != BAD:
            if inside or line[at : at + 1] == b'"':
                closing = _CSV_REST.match(line, at if inside else at + 1)
                if closing is None:
                    return IN, 0
                at = closing.end()
                inside = False
                if at >= end:
                    return OUT, 0
                if line[at : at + gap] != self.delimiter:
                    return BAD, 0
                at += gap
            else:
                found = line.find(self.delimiter, at)
                if found < 0:
                    return OUT, 0
                at = found + gap
        return BAD, 0


# the rest of a quoted field with its closing quote, and a CR before the line end
_CSV_REST = re.compile(rb'[^"]*+(?:""[^"]*+)*+"(?!")(?:\r\Z)?')


@dataclass(frozen=True)
class JsonBraces:
    """Pieces of a JSON document that end with ``}``. ``IN``: the piece begins in a string."""

    separator: bytes = b"}"

    quiet = None

    def step(self, piece: bytes, state: int) -> tuple[int, int]:
        """The state behind the piece and its brace, and the change of depth.

        Escapes and strings are passed over as a whole; a brace in a string counts nothing.
        """
        if state == IN:
            closing = _STRING_REST.match(piece)
            if closing is None:
                return IN, 0
            piece = piece[closing.end() :]
        piece = _STRING.sub(b"", piece)
        opened = piece.find(b'"')
        if opened >= 0:
            piece = piece[:opened]
        depth = piece.count(b"{") + piece.count(b"[") - piece.count(b"}") - piece.count(b"]")
        return (IN, depth) if opened >= 0 else (OUT, depth - 1)


_STRING = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_STRING_REST = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)


# -- ranges -------------------------------------------------------------------


def _pieces(spark: SparkSession, path: str, separator: bytes, tasks: int) -> DataFrame:
    """``value, file, start`` in file order within a range; ``file`` is a hash of the path.

    At most ``tasks`` tasks, each of whole ranges; a task's ranges may come in any order.
    """
    text = spark.read.option("lineSep", separator.decode()).text(path)
    pieces = text.select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    return pieces.coalesce(tasks)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """``(file, start, values)``: stretches of a batch that lie in one range."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch[c].to_numpy() for c in ("file", "start"))
        new = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
            yield int(file[a]), int(start[a]), batch["value"].slice(a, b - a)


def _loud(values: pa.Array, quiet: bytes | None) -> list[int] | range:
    """The places of pieces that can change the state."""
    if quiet is None:
        return range(len(values))
    return np.flatnonzero(pc.match_substring(values, quiet.decode()).to_numpy(zero_copy_only=False)).tolist()


_EFFECT = "file long, start long, bytes long, head binary, out_state int, out_depth long, in_state int, in_depth long"


def _effects(automaton):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _EFFECT.split(", ")]
        at, row = None, None

        def batch(row):
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for file, start, values in _runs(batches):
            if (file, start) != at:
                if row is not None:
                    yield batch(row)
                at, row = (file, start), [file, start, 0, b"" if start else values[0].as_py()[:4096], OUT, 0, IN, 0]
            row[2] += pc.sum(pc.binary_length(values)).as_py() + len(values)
            for i in _loud(values, automaton.quiet):
                piece = values[i].as_py()
                same = row[4] == row[6]
                state, depth = automaton.step(piece, row[4])
                row[4], row[5] = state, row[5] + depth
                if not same:
                    state, depth = automaton.step(piece, row[6])
                row[6], row[7] = state, row[7] + depth
        if row is not None:
            yield batch(row)

    return work


class Ranges(NamedTuple):
    """The state and depth each range begins with; some 50 bytes a range on driver and tasks."""

    keys: np.ndarray
    values: np.ndarray  # file's place, state, depth, target depth, last range without separator
    tasks: int  # that read all of them


def _beginning(keys: np.ndarray, values: np.ndarray, file: int, start: int) -> tuple[int, ...]:
    key = _range_key(file, start)
    at = int(np.searchsorted(keys, key))
    if at == len(keys) or keys[at] != key:
        raise RuntimeError("the file changed, or the size of its ranges, while it was read")
    return tuple(values[at].tolist())


def _range_key(file: int, start: int) -> np.uint64:
    return np.uint64((file * 0x9E3779B97F4A7C15 + start * 0xBF58476D1CE4E5B9) & _MASK)


def _ranges(spark: SparkSession, path: str, automaton, sizes: bool, target) -> Ranges:
    """Pass 1. ``target`` gives the depth behind a record from the file's first bytes."""
    about = [F.col(f"_metadata.file_{what}").alias(what) for what in ("path", "size")]
    listed = spark.read.format("binaryFile").load(path).select(*about).withColumn("file", F.xxhash64("path"))
    files = {r.file: (i, r.path, r.size) for i, r in enumerate(sorted(listed.collect()))}
    size = sum(size for _, _, size in files.values())
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    pieces = _pieces(spark, path, automaton.separator, tasks)
    rows = pieces.mapInArrow(_effects(automaton), _EFFECT).collect()  # one row per range
    keys, values = [], []
    by_file: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r.file, r.start)):
        by_file.setdefault(row.file, []).append(row)
    for file, ranges in by_file.items():
        place, name, length = files[file]
        state, depth, goal = OUT, 0, target(bytes(ranges[0].head), name)
        for row in ranges:
            keys.append(_range_key(row.file, row.start))
            values.append([place, state, depth, goal, 0])
            change = (row.out_state, row.out_depth) if state == OUT else (row.in_state, row.in_depth)
            state, depth = change[0], depth + change[1]
            if state == BAD:
                raise ValueError(f"text behind a closing quote in {name}, at or after byte {row.start}")
        if sizes:
            # every piece was counted with a separator; a byte order mark of three is not read
            values[-1][4] = int(sum(r.bytes for r in ranges) - length in (1, -2))
            if state != OUT or depth + values[-1][4] != 0:
                raise ValueError(f"malformed JSON document: {name} ends within a value")
    keys = np.array(keys, np.uint64)
    order = np.argsort(keys)
    if len(keys) and (np.diff(keys[order]) == 0).any():
        raise RuntimeError("two ranges have one key")
    return Ranges(keys[order], np.array(values, np.int64).reshape(-1, 5)[order], tasks)


# -- records ------------------------------------------------------------------

_CUT = "place int, start long, n long, goal int, record binary"
_HEAD = -1


def _cuts(automaton, sent, whole: bool):
    """Pass 2: whole records, or the heads and tails of records that cross a border.

    ``n`` counts the records that begin in a range; a head, which began before, has -1.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _CUT.split(", ")]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        separator, out = automaton.separator, []
        keys, values_of = sent.value

        def batch():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        at, state, depth, n, held, head = None, OUT, 0, 0, [], False
        place = goal = bare = 0
        waiting: bytes | None = None

        def take(piece: bytes, closed: bool) -> None:
            """One piece; ``closed``: a separator follows."""
            nonlocal state, depth, n, head
            if automaton.quiet is None or automaton.quiet in piece:
                state, change = automaton.step(piece, state)
                depth += change if closed or state == IN else change + 1
            held.append(piece + separator if closed else piece)
            if state == OUT and depth == goal and closed:
                if head != whole:
                    out.append((place, at[1], _HEAD if head else n, goal, b"".join(held)))
                n += not head
                held.clear()
                head = False

        def finish() -> None:
            if waiting is not None:
                take(waiting, not bare)
            if held and not whole:
                out.append((place, at[1], _HEAD if head else n, goal, b"".join(held)))

        for file, start, values in _runs(batches):
            if (file, start) != at:
                if at is not None:
                    finish()
                at, n, waiting = (file, start), 0, None
                held = []
                place, state, depth, goal, bare = _beginning(keys, values_of, file, start)
                # a range goes on with a record unless it begins a file or follows a record's end
                head = start > 0 and (state == IN or depth != goal)
            plain = automaton.quiet is not None and state == OUT and not held and not _loud(values, automaton.quiet)
            if plain:  # every line is a record
                count = len(values)
                if whole:
                    numbers = (np.full(count, v) for v in (place, start, goal))
                    columns = dict(zip(("place", "start", "goal"), numbers, strict=True))
                    columns |= {"n": np.arange(n, n + count), "record": values}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[c], k) if c != "record" else values for c, k in zip(names, kinds, strict=True)],
                        names=names,
                    )
                n += count
                continue
            for piece in values.to_pylist():
                if automaton.quiet is None:  # the last piece of a file may lack its separator
                    if waiting is not None:
                        take(waiting, True)
                    waiting = piece
                else:
                    take(piece, True)
                if len(out) >= 10_000:
                    yield batch()
        if at is not None:
            finish()
        if out:
            yield batch()

    return work


def _records(spark: SparkSession, path: str, automaton, ranges: Ranges) -> DataFrame:
    """``place, start, n, goal, whole, record``: every record of the files.

    ``whole`` is false for records that were joined, and for what is left behind the last
    separator of a file. The two kinds are two scans: the rare one is not worth writing the
    other down for.
    """
    sent = spark.sparkContext.broadcast((ranges.keys, ranges.values))
    pieces = _pieces(spark, path, automaton.separator, ranges.tasks)
    whole = pieces.mapInArrow(_cuts(automaton, sent, True), _CUT).withColumn("whole", F.lit(True))
    # at most two rows a range: a tail and the heads after it are one record
    parts = pieces.mapInArrow(_cuts(automaton, sent, False), _CUT)
    order = Window.partitionBy("place").orderBy("start", "n")
    opened = parts.withColumn("record_no", F.count_if(F.col("n") != _HEAD).over(order))
    joined = opened.groupBy("place", "record_no", "goal").agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "record"))).alias("parts")
    )
    first, empty = F.col("parts")[0], F.lit(b"")
    text = F.aggregate(F.col("parts")["record"], empty, lambda a, b: F.concat(a, b))
    stitched = joined.select(
        "place", first["start"].alias("start"), first["n"].alias("n"), "goal",
        text.alias("record"), F.lit(False).alias("whole"),
    )
    return whole.unionByName(stitched)


# -- CSV ----------------------------------------------------------------------


def read_csv_split(
    spark: SparkSession, path: str, *, delimiter: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """A header CSV as :func:`lauter.sources.read_csv` gives it, of files cut into ranges.

    Fields may span lines and hold CRs. The result is that of one task per file: every
    column a string, a header in every file, records with fewer fields filled up with
    NULL. Text behind a closing quote fails the job. The encoding must keep ASCII bytes as
    they are (UTF-8, Latin-1, Windows code pages); others need ``read_csv``.
    """
    options = {"sep": delimiter, "escape": '"', "multiLine": "true", "encoding": encoding}
    reader = spark.read.options(**options)
    columns = reader.option("header", True).csv(path).columns
    if not columns:
        return spark.range(0).select(F.struct(F.lit(0).alias("place")).alias(POSITION))
    names = [c or "" for c in reader.option("header", False).csv(path).first()]
    separator, crlf = _line_end(spark, path)
    automaton = CsvLines(delimiter.encode(encoding), separator)
    ranges = _ranges(spark, path, automaton, False, lambda head, name: 0)
    rows = _records(spark, path, automaton, ranges)

    # a line end of the file's kind is a newline wherever it stands, in a field too
    decoded = F.decode("record", encoding)
    if crlf or separator == b"\r":
        decoded = F.replace(decoded, F.lit("\r\n" if crlf else "\r"), F.lit("\n"))
    bare = F.expr("left(text, char_length(text) - 1)")
    rows = rows.withColumn("text", decoded).withColumn(
        "text", F.when(F.col("text").endswith("\n"), bare).otherwise(F.col("text"))
    )
    if crlf:  # lines without their separator keep its CR
        rows = rows.withColumn("text", F.regexp_replace("text", r"\r\z", ""))
    schema = ", ".join(f"`_{i}` STRING" for i in range(len(columns)))
    fields = rows.where("text <> ''").withColumn(
        "fields", F.from_csv("text", schema, {**options, "lineSep": "\n"})
    )
    given = F.array(*[F.coalesce(F.col("fields")[f"_{i}"], F.lit("")) for i in range(len(names))])
    expected = F.array(*[F.lit(n.lower()) for n in names])
    right = F.transform(given, F.lower) == expected
    header = (F.col("start") == 0) & (F.col("n") == 0)
    complaint = F.concat(F.lit("a file has another header: "), F.array_join(given, delimiter))
    kept = fields.where(F.when(~header, True).when(right, False).otherwise(F.raise_error(complaint).cast("boolean")))
    return kept.select(
        *[F.col("fields")[f"_{i}"].alias(c) for i, c in enumerate(columns)],
        F.struct("place", "start", "n").alias(POSITION),
    )


def _line_end(spark: SparkSession, path: str) -> tuple[bytes, bool]:
    """The separator byte of the lines, and whether a CR before it belongs to it.

    As the parser does, from the first line end in the first file.
    """
    files = sorted(spark.read.text(path).inputFiles())
    head = paths.head(spark, files[0], 1 << 20) if files else b""
    first = re.search(rb"\r\n|\r|\n", head)
    if first is None or first.group() == b"\n":
        return b"\n", False
    return (b"\n", True) if first.group() == b"\r\n" else (b"\r", False)


# -- JSON ---------------------------------------------------------------------


def _root(head: bytes, name: str) -> int:
    first = head.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
    # a piece ends before its brace, so an object without nested ones can be nothing but a brace
    if first not in (b"[", b"{"):
        raise ValueError(f"expected a JSON array or object in {name}")
    return 1 if first == b"[" else 0


def read_json_split(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Records of JSON document files as :func:`lauter.sources.read_json` gives them, of
    files cut into ranges.

    The records are the objects of an array, or the object itself. Every record is parsed
    together with what stands between it and the one before, so that a malformed document
    fails the job. Files are UTF-8 or another encoding that keeps ASCII bytes as they are,
    and not compressed; a file of no bytes is no document.
    """
    automaton = JsonBraces()
    ranges = _ranges(spark, path, automaton, True, _root)
    rows = _records(spark, path, automaton, ranges)
    text = F.col("text")
    rows = rows.withColumn("text", F.decode("record", encoding)).withColumns(
        {
            "begins": (F.col("start") == 0) & (F.col("n") == 0),
            "ends": ~F.col("whole") & text.rlike(r"\][ \t\r\n]*\z"),
            "blank": text.rlike(r"\A[ \t\r\n]*\z"),
        }
    )
    # each cut as an array of its own: what was before the record, then the record
    opened = F.when(F.col("begins"), text).otherwise(F.concat(F.lit("[0"), text))
    closed = F.when(F.col("ends"), opened).otherwise(F.concat(opened, F.lit("]")))
    alone = F.when(F.col("begins"), text).otherwise(F.lit("more than one value"))
    documents = rows.where(~F.col("blank")).withColumn("document", F.when(F.col("goal") == 1, closed).otherwise(alone))
    records = parse_documents(documents, "document", "place", "start", "n")
    return records.select(
        VARIANT, F.to_json(VARIANT).alias(RECORD), F.struct("place", "start", "n").alias(POSITION)
    )
