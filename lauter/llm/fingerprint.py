"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into longer phrases, and so on. One level:

* a run of equal names is one symbol, named by the name and the length of the run;
* deterministic coin tossing: a symbol's label is the lowest bit in which it differs from
  the symbol before, and the value of that bit. Neighbours stay different, and ``ROUNDS``
  repetitions bring 64-bit names down to labels below 6;
* a phrase begins at every label that is smaller than both neighbours, so it has 2 to some
  12 symbols, 3 on average, and is named by a hash of its symbols.

Where phrases begin depends on ``ROUNDS`` symbols to the left and on one to the right only.
So equal substrings get equal names but for a few phrases at their ends, wherever they
stand. A fingerprint holds the smallest name hashes of a level (bottom-``SKETCH``); the
share of the smallest hashes of two texts that both have estimates the likeness of their
sets of phrases, and is exact for texts of few phrases.

Level 3 has phrases of some 27 characters, level 2 of 9 and level 1 of 3. A short text has
few phrases of level 3; a level is used if it has ``ENOUGH`` phrases, else the one below,
and a text near that border holds both, so that it can be compared with either side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lauter.llm.common import written

LEVELS = 3
ROUNDS = 4
SKETCH = 64
ENOUGH = 16
BORDER = 48
TOGETHER = 1 << 20  # characters parsed in one go
STEP = 1 << 20  # symbols labelled at a time
_HALO = ROUNDS + 2

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


# -- parsing ------------------------------------------------------------------


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 of names of which no two neighbours in a text are equal."""
    now = names
    for _ in range(ROUNDS):
        before = np.empty_like(now)
        before[1:] = now[:-1]
        if len(now):
            before[0] = ~now[0]
        differ = now ^ before
        # the first symbol of a text has no neighbour: bit 0 counts as different
        differ[first] = 1
        one = now.dtype.type(1)
        lowest = differ & (~differ + one)
        now = np.bitwise_count(lowest - one) * np.uint8(2) + ((now & lowest) != 0)
    return now


def phrase_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a phrase begins; ``STEP`` symbols at a time, which changes nothing."""
    n = len(names)
    starts = first.copy()
    for low in range(0, n, STEP):
        high = min(n, low + STEP)
        a, b = max(0, low - _HALO), min(n, high + 1)
        label = labels(names[a:b], first[a:b])
        smaller = np.zeros(b - a, dtype=bool)
        smaller[1:-1] = (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:])
        # neither the second nor the last symbol of a text: a phrase has two symbols
        smaller[1:] &= ~first[a : b - 1]
        smaller[:-1] &= ~first[a + 1 : b]
        starts[low:high] |= smaller[low - a : high - a]
    return starts


def collapse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal names as one symbol each."""
    new = first.copy()
    new[1:] |= names[1:] != names[:-1]
    heads = np.flatnonzero(new)
    length = np.diff(np.append(heads, len(names))).astype(np.uint64)
    short = names[heads].astype(np.uint64)
    long = length > 1
    short[long] = _mix(_mix(short[long] + _C1) + length[long])
    return short, first[heads]


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of one level: their names, and whether they begin a text."""
    names, first = collapse(names, first)
    heads = np.flatnonzero(phrase_starts(names, first))
    out = np.empty(len(heads), np.uint64)
    ends = np.append(heads[1:], len(names))
    low = 0
    while low < len(heads):
        high = max(low + 1, int(np.searchsorted(heads, heads[low] + STEP)))
        a, b = heads[low], ends[high - 1]
        at, size = heads[low:high] - a, ends[low:high] - heads[low:high]
        power, inverse = _powers(int(b - a))
        # a polynomial of the symbols, from the place of the phrase's first one
        sums = np.add.reduceat(_mix(names[a:b] + _C1) * power[: b - a], at) * inverse[at]
        out[low:high] = _mix(sums + size.astype(np.uint64))
        low = high
    return out, first[heads]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""
    if len(_POWERS[0]) < size:
        for i, base in enumerate((int(_C1), pow(int(_C1), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def sketches(names: np.ndarray, text: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, text, count)``: the smallest hashes of every text, and its number of
    different phrases behind each."""
    salted = _mix(names + np.uint64(level * int(_C3) % (1 << 64)))
    hashes = (salted >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    if len(hashes):
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes, text = hashes[new], text[new]
    firsts = np.searchsorted(text, text)
    counts = np.searchsorted(text, text, side="right") - firsts
    keep = np.arange(len(text)) - firsts < SKETCH
    return hashes[keep], text[keep], counts[keep]


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of every text: sections ``level:hashes``, '' for an empty text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.zeros(len(names), dtype=bool)
    first[starts[sizes > 0]] = True
    owner = np.flatnonzero(sizes > 0)
    levels = []
    for _ in range(LEVELS):
        names, first = parse(names, first)
        levels.append((names, owner[np.cumsum(first) - 1]))
    out: list[list[str]] = [[] for _ in texts]
    wanted = np.ones(len(texts), dtype=bool)
    for level in range(LEVELS, 0, -1):
        names, text = levels.pop()
        chosen = wanted[text]
        hashes, text, counts = sketches(names[chosen], text[chosen], level)
        cuts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else text
        digits = hashes.astype(">u4").tobytes().hex()
        bounds = [*(8 * cuts).tolist(), len(digits)]
        for i, (owned, count) in enumerate(zip(text[cuts].tolist(), counts[cuts].tolist(), strict=True)):
            if count >= ENOUGH or level == 1:
                out[owned].append(f"{level}:{digits[bounds[i] : bounds[i + 1]]}")
            if count >= BORDER:
                wanted[owned] = False
    return [";".join(sections) for sections in out]


def likeness(one: str, other: str) -> float:
    """Estimated share of common phrases, 0 to 1, on the highest level that both have.

    Equal fingerprints give 1; an empty text is like empty texts only. Texts without a
    common level differ more than threefold in their number of phrases and count as unlike.
    """
    if one == other:
        return 1.0
    sections = dict(s.split(":") for s in one.split(";") if s)
    for section in other.split(";"):
        level, _, digits = section.partition(":")
        if level in sections and digits:
            mine, theirs = _hashes(sections[level]), _hashes(digits)
            least = sorted(mine | theirs)[:SKETCH]
            return sum(h in mine and h in theirs for h in least) / len(least)
    return 0.0


def _hashes(digits: str) -> set[str]:
    return {digits[i : i + 8] for i in range(0, len(digits), 8)}


# -- documents ----------------------------------------------------------------


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint``, one row per input row; null counts as empty."""
    plain = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    kind = plain.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            at = 0
            for texts in _portions(batch["text"]):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(fingerprints(texts), pa.string())],
                    names=["doc_id", "n_chars", "fingerprint"],
                )
                at += len(texts)

    return plain.mapInArrow(work, f"doc_id {kind}, n_chars long, fingerprint string")


def _portions(column: pa.Array) -> Iterator[list[str]]:
    held, size = [], 0
    for value in column:
        text = value.as_py()
        held.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the following text, or all of it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PLACE = "part long, tail boolean, head boolean"


class _Row:
    __slots__ = ("id", "text", "mark", "head")

    def __init__(self, identity: pa.Scalar, text: str):
        self.id, self.text, self.mark, self.head = identity, text, None, False


def _results(rows: list[_Row]) -> list[tuple]:
    """The rows but the last one, which becomes the first of the next call."""
    new = [r for r in rows if r.mark is None]
    changed = [edited(r.text, n.text) for r, n in zip(rows, rows[1:], strict=False)]
    marks = fingerprints([r.text for r in new] + changed)
    for row, mark in zip(new, marks, strict=False):
        row.mark = mark
    out = []
    for row, following, text, mark in zip(rows, rows[1:], changed, marks[len(new) :], strict=False):
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((len(row.text), sha, row.mark, mark, likeness(row.mark, mark), likeness(row.mark, following.mark)))
    return out


def _stream(kind: pa.DataType, names: list[str]):
    """Rows in order to results; the first row of a task is marked and carries its text, and
    so does the last one, which waits for the first row of the next task."""

    def batch(part: int, rows: list[_Row], values: list[tuple], tail: bool) -> pa.RecordBatch:
        texts = [r.text if (r.head or tail) else None for r in rows]
        columns = list(zip(*values, strict=True)) if values else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r.id.as_py() for r in rows], kind),
                pa.array([part] * len(rows), pa.int64()), pa.array([tail] * len(rows), pa.bool_()),
                pa.array([r.head for r in rows], pa.bool_()), pa.array(texts, pa.string()),
                pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:4]],
                *[pa.array(c, pa.float64()) for c in columns[4:]],
            ],
            names=names,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[_Row] = []
        size, begun = 0, False
        for rows in batches:
            for identity, text in zip(rows["doc_id"], rows["text"], strict=True):
                row = _Row(identity, text.as_py())
                row.head, begun = not begun, True
                held.append(row)
                size += len(row.text)
                if size >= TOGETHER and len(held) > 1:
                    yield batch(part, held[:-1], _results(held), False)
                    held, size = held[-1:], len(held[-1].text)
        if len(held) > 1:
            yield batch(part, held[:-1], _results(held), False)
        if held:
            yield batch(part, held[-1:], [(None,) * 6], True)

    return work


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edit of it that takes in the next document.

    The next document has the next smaller id; after the last one comes the first. Nulls
    count as empty texts, null ids are the smallest, rows of the same id are ordered by a
    hash of their text and then by the text, and repeated rows follow each other. The only
    row of a table is its own next document; an empty table gives no rows.

    Texts are sorted once over all tasks; a task then sees each document and the next one
    and holds some ``TOGETHER`` characters. What joins the end of one task to the beginning
    of another is one row per task.
    """
    plain = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    kind = plain.schema["doc_id"].dataType.simpleString()
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.col("text")]
    ordered = plain.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    shape = f"doc_id {kind}, {_PLACE}, text string, {_RESULT}"
    names = [part.split()[0] for part in shape.replace(f"doc_id {kind}", "doc_id x").split(", ")]
    arrow = _arrow_type(plain)
    # fingerprints are hex digits, which only an entropy coder makes shorter
    found = written(ordered.mapInArrow(_stream(arrow, names), shape), "neighbours", compression="zstd")

    # one narrow row per task with rows: which task comes next
    tasks = found.where("tail").select("part")
    before = Window.orderBy("part")
    following = tasks.select(
        "part", F.coalesce(F.lead("part").over(before), F.min("part").over(before)).alias("next_part")
    )
    # a task of a single row has it as head and tail, so heads come from both kinds of rows
    heads = found.where("head").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = found.where("tail").select("doc_id", "part", "text").join(following, "part").join(heads, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                identity, text, after = (rows[c][i] for c in ("doc_id", "text", "following"))
                value = _results([_Row(identity, text.as_py()), _Row(identity, after.as_py())])[0]
                kinds = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"].slice(i, 1), *[pa.array([v], k) for v, k in zip(value, kinds, strict=True)]],
                    names=["doc_id", *names[5:]],
                )

    last = pairs.select("doc_id", "text", "following").mapInArrow(finish, f"doc_id {kind}, {_RESULT}")
    return found.where("NOT tail").select("doc_id", *names[5:]).unionByName(last)


def _arrow_type(plain: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(plain.schema["doc_id"].dataType)
