"""Near-duplicates by Order MinHash and banded alignment.

1. A text is its words (A-Z lower-cased, as for decontamination); texts of equal words are
   one. The sketch has ``BANDS`` values; each takes the ``KEEP`` smallest hashes among the
   text's 5-word shingles, labelled with their occurrence, and keeps them in text order.
   Texts that agree in a value share shingles in the same order.
2. Texts that agree in a value are a bucket. Every member is paired with the bucket's hub,
   the member that shares most buckets with others, so that a large family of copies costs
   one pair per member.
3. A pair is a link if the sets of 5-word shingles have a Jaccard similarity of 0.8 or
   more and the words an edit similarity of 0.8 or more, found by alignment in a band.
4. Components of links are classes. Buckets that still hold several classes go on: small
   ones with every pair across classes. The members of large ones are joined exactly: their
   shingles are put in one order, the rarest first, and two sets with a Jaccard similarity
   of 0.8 or more share a shingle among the first ones of both. Texts that share such a
   shingle are compared with a hub first, and then every pair across classes that can
   still be similar by its lengths and places.

So any two texts that agree in a value are in one class if they are a link. Texts are sent
once per pair. No step gathers a bucket, class or component in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lauter.llm.common import written, written_and_counted
from lauter.llm.decontaminate import words_of

SHINGLE = 5
BANDS = 16
KEEP = 3
SIMILAR = 0.8
SMALL = 32
ROUNDS = 2  # of hubs, before every pair
SALTED = 1_000  # texts of one shingle in one task

_ODD = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A polynomial hash per word, by running sums over all bytes."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(sizes)
    place = np.arange(len(code)) - np.repeat(ends - sizes, sizes)
    power = np.cumprod(np.full(int(sizes.max()), _ODD), dtype=np.uint64)
    return mixed(np.add.reduceat(code * power[place], ends - sizes) + sizes.astype(np.uint64))


def plain_shingles(words: list[bytes]) -> np.ndarray:
    """A hash per 5-word shingle in text order. Fewer words are one shingle."""
    h = word_hashes(words)
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(h))):
        out = mixed(out * _ODD + h[i : i + n])
    return out


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A hash per 5-word shingle in text order, labelled with its occurrence."""
    out = plain_shingles(words)
    n = len(out)
    order = np.argsort(out, kind="stable")
    ordered = out[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    occurrence = np.zeros(n, np.uint64)
    occurrence[order] = (np.arange(n) - first).astype(np.uint64)
    return mixed(out + occurrence * _B)


_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD)


def sketch(words: list[bytes]) -> np.ndarray:
    """``BANDS`` numbers: the smallest shingles under each hash, in text order."""
    shingles = shingle_hashes(words)
    keep = min(KEEP, len(shingles))
    ranks = mixed(shingles[None, :] ^ _SEEDS[:, None])
    at = np.argpartition(ranks, keep - 1, axis=1)[:, :keep] if keep < len(shingles) else np.tile(np.arange(keep), (BANDS, 1))
    at.sort(axis=1)
    out = _SEEDS.copy()
    for i in range(keep):
        out = mixed(out * _ODD + shingles[at[:, i]])
    return out.view(np.int64)


def key_of(text: bytes, words: list[bytes]) -> bytes:
    """The same for texts of equal words; texts without a word are told apart by their bytes."""
    return hashlib.blake2b(b" ".join(words) if words else b"\x00" + text, digest_size=16).digest()


# -- verification -------------------------------------------------------------


def similar(left: bytes, right: bytes, least: float = SIMILAR) -> bool:
    """Whether shingle sets and word sequences are both similar enough."""
    a, b = words_of(left), words_of(right)
    if not a or not b or min(len(a), len(b)) < least * (max(len(a), len(b)) - SHINGLE):
        return False
    number: dict[bytes, str] = {}
    x = "".join([number.setdefault(w, chr(0x10000 + len(number))) for w in a])
    y = "".join([number.setdefault(w, chr(0x10000 + len(number))) for w in b])
    s, t = ({z[i : i + SHINGLE] for i in range(max(1, len(z) - SHINGLE + 1))} for z in (x, y))
    both = len(s & t)
    if both < least * (len(s) + len(t) - both):
        return False
    most = int((1 - least) * max(len(x), len(y)) + 1e-9)
    return edits_within(x, y, most)


def _run(x: str, y: str, i: int, j: int) -> int:
    """How many symbols from ``x[i]`` and ``y[j]`` on are the same."""
    n, step, most = 0, 16, min(len(x) - i, len(y) - j)
    while n < most:
        step = min(step, most - n)
        if x[i + n : i + n + step] == y[j + n : j + n + step]:
            n += step
            step *= 2
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return n


def edits_within(x: str, y: str, most: int) -> bool:
    """Whether ``most`` insertions, deletions and replacements turn x into y.

    Alignment in a band: for each number of edits, how far each diagonal reaches; the
    diagonals are those within ``most`` of the main one.
    """
    if abs(len(x) - len(y)) > most:
        return False
    goal = len(y) - len(x)
    reach = {0: _run(x, y, 0, 0)}
    edits = 0
    while reach.get(goal, -1) < len(x):
        edits += 1
        if edits > most:
            return False
        new = {}
        for d in range(max(-edits, -most), min(edits, most) + 1):
            if abs(goal - d) > most - edits:  # cannot come back to the goal
                continue
            i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2))
            i = min(i, len(x), len(y) - d)
            if i < 0 or i + d < 0:
                continue
            new[d] = i + _run(x, y, i, i + d)
        reach = new
    return True


# -- jobs ---------------------------------------------------------------------


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, bands`` per row; texts without words have no bands."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands = [], []
            for value in batch.column(1).cast(pa.binary()):
                text = value.as_py() or b""
                words = words_of(text)
                keys.append(key_of(text, words))
                bands.append(sketch(words) if words else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "key", "bands"],
            )

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(make, f"doc_id {kind}, key binary, bands array<long>")


def with_key(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__key``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            plain = [t.as_py() or b"" for t in texts]
            keys = pa.array([key_of(t, words_of(t)) for t in plain], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "__key"])

    return docs.mapInArrow(add, docs.select("*", F.lit(b"").alias("__key")).schema)


def components(links: DataFrame) -> DataFrame:
    """``key, component`` (its smallest key) for every key of ``links`` (``left, right``).

    Each round every node takes the smallest component of its neighbours and then the
    component of that component, so the rounds grow with the logarithm of the longest
    path. Each round is written: nothing is computed twice or lost with an executor.
    """
    both = links.select(F.col("left").alias("key"), F.col("right").alias("near")).unionByName(
        links.select(F.col("right").alias("key"), F.col("left").alias("near"))
    )
    # in the first round a node's component is itself
    least = both.groupBy("key").agg(F.min("near").alias("least"))
    state = written(least.select("key", F.least("key", "least").alias("component")), "components")
    while True:
        near = both.join(state.select(F.col("key").alias("near"), "component"), "near")
        least = near.groupBy("key").agg(F.min("component").alias("least"))
        moved = state.join(least, "key").select("key", F.col("component").alias("was"), F.least("component", "least").alias("to"))
        jump = state.select(F.col("key").alias("to"), F.col("component").alias("then"))
        moved = moved.join(jump, "to").select("key", "was", F.least("to", "then").alias("component"))
        state, seen = written_and_counted(moved, "components", moved=F.count_if(F.col("was") != F.col("component")))
        state = state.select("key", "component")
        if not seen["moved"]:
            return state


def _merged(state: DataFrame, links: DataFrame) -> DataFrame:
    """``key, component`` as in ``state``, after joining the components that ``links`` connect."""
    to = components(links).select(F.col("key").alias("component"), F.col("component").alias("to"))
    moved = state.join(to, "component", "left")
    return written(moved.select("key", F.coalesce("to", "component").alias("component")), "classes")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``left, right, link`` for each pair."""
    first = texts.select(F.col("key").alias("left"), F.col("t").alias("a"))
    second = texts.select(F.col("key").alias("right"), F.col("t").alias("b"))
    both = pairs.join(first, "left").join(second, "right").select("left", "right", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            found = [similar(x.as_py(), y.as_py()) for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.bool_())], names=["left", "right", "link"]
            )

    return both.mapInArrow(compare, "left binary, right binary, link boolean")


def _pair(a, b) -> list:
    return [F.least(a, b).alias("left"), F.greatest(a, b).alias("right")]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, small: int = SMALL) -> DataFrame:
    """``doc_id, class_id, class_size, kept, key``, one row per input row.

    ``class_id`` is the smallest id of the class (null if all its ids are null), and the
    row of that id is ``kept``; rows of one id and equal words are all marked alike. Null
    text counts as empty; texts without words are near only to their exact copies. An
    empty table gives no rows.
    """
    rows = written(sketches(docs, id_col, text_col), "sketches")
    texts_of = rows.groupBy("key").agg(F.first("bands").alias("bands"))
    members = texts_of.select("key", F.posexplode("bands").alias("band", "value"))
    sizes = members.groupBy("band", "value").agg(F.count("*").alias("m")).where("m > 1")
    # only buckets of several texts go on
    members = written(members.join(sizes, ["band", "value"]), "members")
    central = members.groupBy("key").agg(F.sum("m").alias("shared"))
    members = written(members.join(central, "key"), "members")
    nodes = written(members.select("key").distinct(), "nodes")

    # one text per key that is in a bucket
    carriers = rows.join(nodes, "key").groupBy("key").agg(F.min("doc_id").alias("i"))
    plain = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    named = carriers.select(F.col("i").alias("__i")).distinct()
    held = plain.join(named, F.col("i").eqNullSafe(F.col("__i")), "left_semi")
    texts = written(_of_key(held).join(nodes, "key"), "texts")
    pairs = written(_stars(members, ["band", "value"]).distinct(), "pairs")
    checked = written(_verified(pairs, texts), "verified")
    state = _merged(nodes.select("key", F.col("key").alias("component")), checked.where("link"))
    # buckets of several classes
    mixed_up, seen = written_and_counted(
        _mixed(members.join(state, "key"), ["band", "value"]), "mixed",
        few=F.count_if(F.col("held") <= small), many=F.count_if(F.col("held") > small),
    )
    if seen["few"]:
        few = _across(mixed_up.where(F.col("held") <= small), ["band", "value"])
        checked, state = _more(few, checked, state, texts)
    if seen["many"]:
        large = mixed_up.where(F.col("held") > small).select("key").distinct()
        now = _first_shingles(large, texts)
        for turn in range(ROUNDS + 1):
            # texts of one class stay in one: what a turn leaves out, no later one needs
            held = _several(now.drop("component", "m").join(state, "key"))
            now, seen = written_and_counted(held, "shingles", rows=F.count("*"))
            if not seen["rows"]:
                break
            pairs = _hub_pairs(now, turn) if turn < ROUNDS else _possible(now)
            checked, state = _more(pairs, checked, state, texts)
    return _classes(rows, state)


def _more(pairs: DataFrame, checked: DataFrame, state: DataFrame, texts: DataFrame):
    """The checked pairs and the classes, with what the new ones of ``pairs`` add."""
    new = pairs.distinct().join(checked, ["left", "right"], "left_anti")
    new, seen = written_and_counted(new, "pairs", rows=F.count("*"))
    if not seen["rows"]:
        return checked, state
    found, seen = written_and_counted(_verified(new, texts), "verified", links=F.count_if("link"))
    both = checked.unionByName(found)
    if not seen["links"]:
        return both, state
    # the new links connect whole classes: only these are looked at again
    one = state.select(F.col("key").alias("left"), F.col("component").alias("a"))
    two = state.select(F.col("key").alias("right"), F.col("component").alias("b"))
    across = found.where("link").join(one, "left").join(two, "right").where("a <> b")
    across = across.select(*_pair(F.col("a"), F.col("b"))).distinct()
    return both, _merged(state, written(across, "links"))


def _hub() -> Column:
    """The member that shares most buckets."""
    return F.min(F.struct(-F.col("shared"), F.xxhash64("key"), "key"))["key"].alias("hub")


def _stars(members: DataFrame, cell: list[str]) -> DataFrame:
    """Each member of a cell with the cell's hub."""
    hubs = members.groupBy(*cell).agg(_hub())
    pairs = members.select(*cell, "key").join(hubs, cell).where("key <> hub")
    return pairs.select(*_pair(F.col("key"), F.col("hub")))


def _mixed(members: DataFrame, cell: list[str]) -> DataFrame:
    """The members of cells with several classes, with the cell's size ``held`` and its ``hub``."""
    counts = members.groupBy(*cell).agg(
        F.count("*").alias("held"), F.min("component").alias("low"), F.max("component").alias("high"), _hub()
    )
    mixed_up = counts.where("low <> high").select(*cell, "held", "hub")
    return members.drop("held").join(mixed_up, cell)


def _across(members: DataFrame, cell: list[str]) -> DataFrame:
    """All pairs of one cell and two classes; for cells of bounded size only."""
    one = members.select(*cell, F.col("key").alias("a"), F.col("component").alias("c"))
    two = members.select(*cell, F.col("key").alias("b"), F.col("component").alias("d"))
    pairs = one.join(two, cell).where("a < b AND c <> d")
    return pairs.select(F.col("a").alias("left"), F.col("b").alias("right"))


def _first_shingles(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """``key, shingle, n, rank``: the first of each text's ``n`` different shingles.

    Shingles are ordered by the number of texts that hold them, the rarest first, and
    ``rank`` counts from 0. A set of n shingles that is similar to another one shares more
    than all but its first ``n - SIMILAR * n + 1`` with it, so one of them is among these.
    Shingles of one text come first and are in no pair: they are only counted.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(plain_shingles(words_of(t.as_py()))).view(np.int64) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                names=["key", "n", "shingles"],
            )

    sets = texts.join(keys, "key", "left_semi").select("key", "t").mapInArrow(make, "key binary, n long, shingles array<long>")
    held = written(sets.select("key", "n", F.explode("shingles").alias("shingle")), "shingles")
    often = held.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    own = held.join(often, "shingle").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("own"))
    ranked = own.select("key", "n", F.size("own").alias("common"), F.posexplode("own").alias("at", "one"))
    ranked = ranked.select("key", F.col("one.shingle").alias("shingle"), "n", (F.col("n") - F.col("common") + F.col("at")).alias("rank"))
    return ranked.where(F.col("rank") <= F.col("n") - _least(F.col("n") * SIMILAR))


def _least(x: Column) -> Column:
    """The smallest whole number that is not below x, but for rounding."""
    return F.ceil(x - 1e-6)


def _several(held: DataFrame) -> DataFrame:
    """The rows of shingles that texts of several classes hold, with the number of texts ``m``."""
    counts = held.groupBy("shingle").agg(F.count("*").alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
    return held.join(counts.where("low <> high").select("shingle", "m"), "shingle")


def _can_be_similar(a: str, b: str) -> Column:
    """Whether a pair may have enough shingles in common, by its sizes and what follows its ranks."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    after = F.least(n - F.col(f"{a}.rank"), m - F.col(f"{b}.rank"))
    return after >= _least((n + m) * (SIMILAR / (1 + SIMILAR)))


def _hub_pairs(held: DataFrame, turn: int) -> DataFrame:
    """Each text with the hub of its shingle, another one each turn."""
    hub = F.struct(F.xxhash64("key", F.lit(turn)), "key", "n", "rank", "component")
    hubs = held.groupBy("shingle").agg(F.min(hub).alias("hub"))
    pairs = held.alias("a").join(hubs, "shingle").where(F.col("a.component") != F.col("hub.component"))
    return pairs.where(_can_be_similar("a", "hub")).select(*_pair(F.col("a.key"), F.col("hub.key")))


def _possible(held: DataFrame) -> DataFrame:
    """Every pair across classes that can be similar, from shingles cut into blocks."""
    blocks = F.ceil(F.col("m") / SALTED).cast("int")
    one = held.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    two = held.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pairs = one.alias("a").join(two.alias("b"), ["shingle", "block"])
    pairs = pairs.where((F.col("a.key") < F.col("b.key")) & (F.col("a.component") != F.col("b.component")))
    return pairs.where(_can_be_similar("a", "b")).select(F.col("a.key").alias("left"), F.col("b.key").alias("right"))


def _of_key(held: DataFrame) -> DataFrame:
    """One text per key; a repeated id may carry several."""
    return with_key(held.select("t"), "t").groupBy(F.col("__key").alias("key")).agg(F.min("t").alias("t"))


def _classes(rows: DataFrame, state: DataFrame) -> DataFrame:
    named = rows.select("doc_id", "key").join(state, "key", "left")
    named = named.select("doc_id", "key", F.coalesce("component", "key").alias("class"))
    per = named.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"),
        F.min(F.when(F.col("doc_id").isNull(), F.col("key"))).alias("unnamed"),
    )
    kept = F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull() & (F.col("key") == F.col("unnamed")))
    return named.join(per, "class").select("doc_id", "class_id", "class_size", kept.alias("kept"), "key")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each class, with all its columns.

    Of rows with the kept id, one whose words are those of the class stays.
    """
    decided = near_duplicates(docs, id_col, text_col).where("kept")
    # rows of one id may hold different texts of one class
    one = decided.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("key")).alias("k")).agg(F.min("key").alias("__k"))
    one = one.select(F.col("class_id").alias("__i"), "__k")
    named = with_key(docs, text_col)
    same = (named["__key"] == one["__k"]) & named[id_col].eqNullSafe(one["__i"])
    left = named.join(one, same, "left_semi").withColumn("__id", F.col(id_col))
    repeats = left.groupBy("__id", "__key").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("__id").alias("__i"), F.col("__key").alias("__k")
    )
    pair = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__key") == F.col("__k"))
    once = left.join(repeats, pair, "left_anti")
    tied = left.join(repeats, pair, "left_semi").dropDuplicates(["__id", "__key"])
    return once.unionByName(tied).drop("__key", "__id")
