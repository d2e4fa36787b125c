"""Removal of passages that occur elsewhere, through suffix order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts at another place of
the corpus.

1. Texts that are equal as a whole are one; a text that occurs twice is all repeated.
2. Every window of ``LENGTH`` bytes has an anchor, the leftmost of its grams with the
   smallest hash. It depends on the window's bytes only, so equal windows have equal
   anchors at the same offset. Anchors whose hash occurs once have no repeated window.
   A gram is a third of a window: phrases of everyday language are shorter and do not
   repeat as anchors, and there is still only one anchor in some 130 bytes.
3. The windows of one anchor span a context, some hundred bytes around it. Contexts of one
   anchor hash meet; equal ones are one, with a count, combined before the shuffle.
4. What is left of an anchor and what is right of it are put in suffix order, each by the
   grouping construction below. In that order the contexts that share at least ``t``
   bytes with each other are runs, so for every offset the windows that are equal are
   those in the same run on the left and in the same run on the right.
5. An anchor with more than ``HOT`` different contexts is cut by what its windows have in
   common: contexts that differ there share no window. Pieces get finer until a piece is a
   window, so no group is ever larger than ``HOT`` in a task.

The suffix array (:func:`suffix_array`) follows the Lyndon-grouping method: suffixes are
grouped by their longest Lyndon prefix, groups from the largest down, each moving the
suffixes that its previous-smaller pointers lead to; then the order within groups follows
from the order of what comes after. Its symbols are 64-byte blocks, ranked by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lauter.llm.common import written
from lauter.llm.near_dedup import mixed

LENGTH = 400
GRAM = 1 / 3
BLOCK = 64
HOT = 4_000
PIECES = (64, 1)
TOGETHER = 6_000

_ODD = 0x9E3779B97F4A7C15


# -- suffix order -------------------------------------------------------------


def suffix_array(text: list[int]) -> list[int]:
    """The order of the suffixes of a list of numbers from 0.

    Groups lie in ``order`` one after the other; ``head`` is where the group of a suffix
    begins. A group that was passed never changes again.
    """
    n = len(text)
    if not n:
        return []
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    head = [0] * n
    size: dict[int, int] = {}
    first = 0
    for at, i in enumerate(order):
        if text[i] != text[order[first]]:
            first = at
        place[i] = at
        head[i] = first
        size[first] = size.get(first, 0) + 1
    before = [-1] * n  # the last suffix to the left in a lower group
    end = n
    while end:
        start = head[order[end - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(order[start:end]):
            j = i - 1
            while j >= 0 and head[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        end = start
        moves: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            moves.setdefault((-times, head[j]), []).append(j)
        # more pointers first: what moves later comes to lie below
        for (_, group), some in sorted(moves.items()):
            left = size[group] - len(some)
            if not left:
                continue
            fresh = group + left
            to = fresh + len(some)
            for j in some:
                to -= 1
                other, here = order[to], place[j]
                order[here], order[to] = other, j
                place[other], place[j] = here, to
            for j in some:
                head[j] = fresh
            size[group], size[fresh] = left, len(some)
    return _ordered(n, text, head, before)


def _ordered(n: int, text: list[int], head: list[int], before: list[int]) -> list[int]:
    """Within groups: the suffixes whose Lyndon prefix ends where the next in order begins."""
    out = [-1] * n
    free = {h: h for h in set(head)}
    done = [False] * n

    def follow(j: int) -> None:
        while j >= 0 and not done[j]:
            done[j] = True
            out[free[head[j]]] = j
            free[head[j]] += 1
            j = before[j]

    follow(n - 1)  # the Lyndon prefixes that end with the text
    for at in range(n):
        follow(out[at] - 1)
    return out


def ranked(groups: list[int], strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings by group and bytes, and each one's common prefix with the one before."""
    blocks = [[s[i : i + BLOCK] for i in range(0, len(s), BLOCK)] for s in strings]
    rank = {b: r + 1 for r, b in enumerate(sorted({b for some in blocks for b in some}))}
    text: list[int] = []
    starts: dict[int, int] = {}
    for number, (group, some) in enumerate(zip(groups, blocks, strict=True)):
        starts[len(text)] = number
        text.append(len(rank) + 1 + group)
        text.extend([rank[b] for b in some])
        text.append(0)
    order = [starts[i] for i in suffix_array(text) if i in starts]
    common = np.zeros(len(order), np.int64)
    for at in range(1, len(order)):
        a, b = order[at - 1], order[at]
        if groups[a] == groups[b]:
            common[at] = _common(strings[a], strings[b])
    return np.array(order, np.int64), common


def _common(a: bytes, b: bytes) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # equal up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def repeated(groups: list[int], contexts: list[bytes], anchor: list[int], times: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, whether each of its windows occurs again in its group."""
    count = len(contexts)
    at = np.array(anchor)
    windows = np.array([len(c) - length + 1 for c in contexts])
    right, right_common = ranked(groups, [c[a:] for c, a in zip(contexts, anchor, strict=True)])
    left, left_common = ranked(groups, [c[:a][::-1] for c, a in zip(contexts, anchor, strict=True)])
    group = np.array(groups)
    new_right, new_left = (np.append(True, np.diff(group[o]) != 0) for o in (right, left))
    most = int(at.max(initial=0))
    again = np.zeros((count, int(windows.max(initial=0))), bool)
    again[np.array(times) > 1] = True
    run_right, run_left = np.zeros(count, np.int64), np.zeros(count, np.int64)
    # offset: bytes from the window's start to the anchor
    for offset in range(max(0, int((at - windows + 1).min(initial=0))), most + 1):
        some = np.flatnonzero((offset <= at) & (offset > at - windows))
        if not len(some):
            continue
        run_right[right] = np.cumsum(new_right | (right_common < length - offset))
        run_left[left] = np.cumsum(new_left | (left_common < offset))
        both = run_left[some] * (count + 1) + run_right[some]
        _, inverse, held = np.unique(both, return_inverse=True, return_counts=True)
        twice = some[held[inverse] > 1]
        again[twice, at[twice] - offset] = True
    return [row[:n] for row, n in zip(again, windows, strict=True)]


# -- anchors ------------------------------------------------------------------


class Anchors:
    """Anchors of a text's windows."""

    def __init__(self, length: int = LENGTH, gram: float = GRAM):
        self.length, self.gram = length, max(1, int(length * gram))
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            back = pow(_ODD, -1, 2**64)
            self.power = np.cumprod(np.append(np.uint64(1), np.full(n, _ODD, np.uint64)), dtype=np.uint64)
            self.inverse = np.cumprod(np.append(np.uint64(1), np.full(n, back, np.uint64)), dtype=np.uint64)

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and place of each anchor, and the first window it belongs to."""
        n, k, w = len(text), self.gram, self.length - self.gram + 1
        windows = n - self.length + 1
        if windows < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self._powers(n + 1)
        code = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(code * self.power[:n], out=sums[1:])
        grams = mixed((sums[k:] - sums[:-k]) * self.inverse[: n - k + 1])
        # smallest from each side within rows of w grams; the low bits hold the place
        rows = -(-len(grams) // w) + 1
        packed = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
        packed[: len(grams)] = (grams >> np.uint64(9)) << np.uint64(9)
        packed = packed.reshape(rows, w) | np.arange(w, dtype=np.uint64)
        ahead = np.minimum.accumulate(packed[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
        behind = np.minimum.accumulate(packed, axis=1).ravel()[w - 1 : w - 1 + windows]
        row = np.arange(windows) // w
        own = (ahead >> np.uint64(9)) <= (behind >> np.uint64(9))
        # a window that begins with a row ends with it
        whole = np.arange(windows) % w == 0
        places = (np.where(own, ahead, behind) & np.uint64(511)).astype(np.int64)
        places += np.where(own | whole, row, row + 1) * w
        first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        at = places[first]
        return grams[at].view(np.int64), at.astype(np.int32), first.astype(np.int32)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


# -- jobs ---------------------------------------------------------------------


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """Per row: ``doc_id, key, n_bytes, sha`` and its anchors."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in batches:
            keys, sizes, shas, hashes, places, firsts = [], [], [], [], [], []
            for value in batch.column(1).cast(pa.binary()):
                text = value.as_py() or b""
                keys.append(digest(text))
                sizes.append(len(text))
                shas.append(hashlib.sha256(text).hexdigest())
                h, p, f = anchors.of(text)
                hashes.append(h)
                places.append(p)
                firsts.append(f)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                    pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())),
                    pa.array(firsts, pa.list_(pa.int32())),
                ],
                names=["doc_id", "key", "n_bytes", "sha", "h", "p", "f"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key binary, n_bytes long, sha string, h array<long>, p array<int>, f array<int>"
    return docs.mapInArrow(make, schema)


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """``key, lo, h, a, d, ctx``: for each anchor with a hash of ``hs`` its windows' bytes, ``a``
    the anchor's place in them, ``d`` their digest, ``lo`` where they begin."""
    schema = pa.schema([
        ("key", pa.binary()), ("lo", pa.int64()), ("h", pa.int64()), ("a", pa.int32()), ("d", pa.binary()), ("ctx", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text, *marks in zip(*batch.columns, strict=True):
                key, text = key.as_py(), text.as_py()
                hs, h, p, f = (m.values.to_numpy() for m in marks)
                last = np.append(f[1:] - 1, len(text) - length)
                some = np.isin(h, hs)
                for own, place, lo, hi in zip(h[some].tolist(), p[some].tolist(), f[some].tolist(), last[some].tolist(), strict=True):
                    ctx = text[lo : hi + length]
                    rows.append((key, lo, own, place - lo, digest(ctx), ctx))
                    if len(rows) == 5_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return texts.mapInArrow(cut, "key binary, lo long, h long, a int, d binary, ctx binary")


_RUNS = "array<struct<i:int,j:int>>"


def _runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"i": int(i), "j": int(j) - 1} for i, j in edge.reshape(-1, 2)]


def _judge(groups: DataFrame, length: int) -> DataFrame:
    """``g, d, shift, runs`` of repeated windows for contexts ``g, d, shift, a, n, ctx``.

    Groups lie whole in a task, one after the other; as many as make ``TOGETHER`` contexts
    are put in order together.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            names: dict[bytes, int] = {}
            number = [names.setdefault(r[0], len(names)) for r in held]
            flags = repeated(number, [r[5] for r in held], [r[3] for r in held], [r[4] for r in held], length)
            kind = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in held], pa.binary()), pa.array([r[1] for r in held], pa.binary()),
                    pa.array([r[2] for r in held], pa.int32()), pa.array([_runs(f) for f in flags], kind),
                ],
                names=["g", "d", "shift", "runs"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= TOGETHER and row[0] != held[-1][0]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    ordered = groups.select("g", "d", "shift", "a", "n", "ctx").repartition("g").sortWithinPartitions("g")
    return ordered.mapInArrow(judge, f"g binary, d binary, shift int, runs {_RUNS}")


def _pieces(contexts: DataFrame, piece: int, length: int) -> DataFrame:
    """Contexts cut so that a piece holds windows of ``piece`` neighbouring offsets.

    Windows of one piece have ``length - piece + 1`` bytes in common, which go into the
    group's name: two contexts that differ there have no equal window in this piece.
    """
    rows = contexts.withColumn("w", F.octet_length("ctx") - length + 1)
    low, high = "floor((a - w + 1) / {0})", "floor(a / {0})"
    rows = rows.withColumn("q", F.explode(F.expr(f"sequence(cast({low.format(piece)} as int), cast({high.format(piece)} as int))")))
    # windows of this piece: offsets q * piece up to (q + 1) * piece - 1
    rows = rows.withColumn("i", F.expr(f"greatest(0, a - (q + 1) * {piece} + 1)"))
    rows = rows.withColumn("j", F.expr(f"least(w - 1, a - q * {piece})")).where("i <= j")
    shared = F.expr(f"substring(ctx, a - q * {piece} + 1, {length - piece + 1})")
    return rows.select(
        F.unhex(F.sha2(F.concat("g", F.col("q").cast("string").cast("binary"), shared), 256)).alias("g"),
        "d", (F.col("shift") + F.col("i")).alias("shift"), (F.col("a") - F.col("i")).alias("a"), "n",
        F.expr(f"substring(ctx, i + 1, j - i + {length})").alias("ctx"), "h",
    )


def _repeated_windows(items: DataFrame, length: int, hot: int) -> DataFrame:
    """``h, d, shift, runs`` for every context (anchor hash, digest) with repeated windows."""
    # copies are combined before the shuffle; ``a`` follows from ``ctx``
    distinct = written(items.groupBy("h", "d", "a", "ctx").agg(F.count("*").alias("n")), "distinct-contexts")
    kinds = distinct.groupBy("h").agg(F.count("*").alias("kinds"))
    several = written(kinds.where("kinds > 1"), "anchors")
    # contexts that are all the same are repeated as a whole
    same = distinct.where("n > 1").select(
        "h", "d", F.lit(0).alias("shift"),
        F.array(F.struct(F.lit(0).alias("i"), (F.octet_length("ctx") - length).cast("int").alias("j"))).cast(_RUNS).alias("runs"),
    )
    found = [same]
    level = distinct.join(several.where(F.col("kinds") <= hot).select("h"), "h")
    level = level.select(F.col("h").cast("string").cast("binary").alias("g"), "d", F.lit(0).alias("shift"), "a", "n", "ctx")
    found.append(_named(level, _judge(level, length)))
    rest = distinct.join(several.where(F.col("kinds") > hot).select("h"), "h")
    if not several.where(F.col("kinds") > hot).isEmpty():
        rest = rest.select(F.col("h").cast("string").cast("binary").alias("g"), "d", F.lit(0).alias("shift"), "a", "n", "ctx", "h")
        for piece in PIECES:
            rest = _pieces(rest, piece, length)
            # equal pieces of different contexts count together
            pieces = written(rest, "pieces")
            kinds = pieces.groupBy("g", "a", "ctx").agg(F.sum("n").alias("total"))
            sizes = written(kinds.groupBy("g").agg(F.count("*").alias("kinds"), F.sum("total").alias("all")), "piece-groups")
            whole = pieces.join(sizes.where("kinds = 1 AND all > 1").select("g"), "g")
            found.append(_whole(whole, length))
            small = kinds.join(sizes.where((F.col("kinds") > 1) & (F.col("kinds") <= hot)).select("g"), "g")
            small = small.select("g", F.md5("ctx").cast("binary").alias("d"), F.lit(0).alias("shift"), "a", F.col("total").alias("n"), "ctx")
            judged = _judge(small, length).withColumnRenamed("d", "m").withColumnRenamed("shift", "none")
            own = pieces.select("g", "d", "shift", "h", F.md5("ctx").cast("binary").alias("m"))
            found.append(own.join(judged, ["g", "m"]).select("h", "d", "shift", "runs"))
            rest = pieces.join(sizes.where(F.col("kinds") > hot).select("g"), "g")
            if sizes.where(F.col("kinds") > hot).isEmpty():
                break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.where(F.size("runs") > 0)


def _named(level: DataFrame, judged: DataFrame) -> DataFrame:
    return judged.select(F.col("g").cast("string").cast("long").alias("h"), "d", "shift", "runs")


def _whole(pieces: DataFrame, length: int) -> DataFrame:
    last = (F.octet_length("ctx") - length).cast("int")
    runs = F.array(F.struct(F.lit(0).alias("i"), last.alias("j"))).cast(_RUNS)
    return pieces.select("h", "d", "shift", runs.alias("runs"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH, hot: int = HOT
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``, one row per input row.

    ``spans`` are the removed [start, stop) bytes, in order, apart from each other. Null
    text counts as empty. Texts of fewer than ``length`` bytes lose nothing. Rows of the
    same text repeat each other, also when they are repeated as a whole.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    rows = written(_anchored(plain, length), "anchored")
    texts_of = rows.groupBy("key").agg(
        F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"),
        F.min("doc_id").alias("i"), F.first(F.struct("h", "p", "f")).alias("anchors"),
    )
    one = written(texts_of.where(F.col("n_bytes") >= length), "texts")
    often = one.select(F.explode("anchors.h").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    often = written(often.where("n > 1").select("h"), "often")
    # a hash that one text holds many times is one row of it
    pairs = one.select("key", F.explode(F.array_distinct("anchors.h")).alias("h"))
    some = pairs.join(often, "h").groupBy("key").agg(F.collect_list("h").alias("hs"))
    marks = one.join(some, "key").select("key", "i", "hs", "anchors.h", "anchors.p", "anchors.f")

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, text, *marks = batch.columns
            text = text.cast(pa.binary()).fill_null(b"")
            # a repeated id may carry other texts
            own = [digest(t.as_py()) == k.as_py() for t, k in zip(text, key, strict=True)]
            found = pa.RecordBatch.from_arrays([key, text, *marks], names=batch.schema.names)
            yield found.filter(pa.array(own, pa.bool_()))

    held = plain.join(marks, F.col("doc_id").eqNullSafe(F.col("i"))).select("key", "t", "hs", "h", "p", "f")
    held = held.mapInArrow(same, "key binary, t binary, hs array<long>, h array<long>, p array<int>, f array<int>")
    texts = written(held, "marked-texts")
    items = written(_contexts(texts, length), "contexts")
    repeats = _repeated_windows(items, length, hot)
    return _cut(rows, one, texts, items, repeats, length)


def _cut(rows, one, texts, items, repeats, length) -> DataFrame:
    spans = items.select("key", "lo", "h", "d").join(repeats, ["h", "d"])
    spans = spans.select("key", F.explode("runs").alias("r"), (F.col("lo") + F.col("shift")).alias("lo"))
    spans = spans.groupBy("key").agg(
        F.collect_set(F.struct((F.col("lo") + F.col("r.i")).alias("start"), (F.col("lo") + F.col("r.j") + length).alias("stop"))).alias("runs")
    )
    once = one.where("copies = 1").select("key")
    cut = texts.select("key", "t").join(once, "key").join(spans, "key")
    span = "array<struct<start:long,stop:long>>"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas, found = [], [], []
            for text, runs in zip(batch.column(1), batch.column(2), strict=True):
                text, own, kept, end = text.as_py(), [], [], 0
                for r in sorted(runs.as_py(), key=lambda r: r["start"]):
                    if own and r["start"] <= own[-1]["stop"]:
                        own[-1]["stop"] = max(own[-1]["stop"], r["stop"])
                    else:
                        own.append(dict(r))
                for r in own:
                    kept.append(text[end : r["start"]])
                    end = r["stop"]
                kept.append(text[end:])
                removed.append(sum(r["stop"] - r["start"] for r in own))
                shas.append(hashlib.sha256(b"".join(kept)).hexdigest())
                found.append(own)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(found, kind)],
                names=["key", "removed", "kept_sha", "spans"],
            )

    cut = cut.select("key", "t", "runs").mapInArrow(remove, f"key binary, removed long, kept_sha string, spans {span}")
    several = one.where("copies > 1").select("key", F.lit(True).alias("all"))
    out = rows.select("doc_id", "key", "n_bytes", "sha").join(cut, "key", "left").join(several, "key", "left")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast(span)
    spans = F.when(F.col("all"), everything).otherwise(F.coalesce("spans", none))
    return out.select(
        "doc_id", "n_bytes",
        F.when(F.col("all"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(F.col("all"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        spans.alias("spans"),
    )
