"""The trie of conversation prefixes, found by truncation peeling.

1. A turn is a digest of its role and text and a number of words; texts travel no further.
   The digests of a conversation, one behind the other, are its sequence: 16 bytes a turn.
2. Conversations with equal sequences are one, with a count. Their ids are hashed in
   numerical order: a distributed sort, then each task turns its stretch into pieces of text
   and the pieces of one sequence are read in order, a piece at a time. However many copies
   there are, no task holds their ids.
3. Sequences are sorted over all tasks, so that a prefix is a stretch of neighbours and a
   hot first turn is spread over as many tasks as it has rows. A task takes blocks of
   bounded size and peels each one: from the greatest depth upwards, the sequences that end
   at a depth join the nodes that survive from the depth below, lose their last turn and are
   regrouped. Members, children, leaves and tokens add up on the way, so nodes are found
   and aggregated in the same pass.
4. Only nodes on the first and on the last path of a block can go on in another block.
   They leave the task as partial sums, at most two paths a block, and are peeled together
   in the same way, from the greatest depth upwards. Their children in the blocks get the
   parent's conversation by a join.

The number of jobs and shuffles does not depend on the depth.

Rows without a ``conv_id`` belong to no conversation and are left out. Null role and text
count as empty, a null turn comes first, equal turns are ordered by digest; repeated rows are
turns of their own. An empty table gives no rows, not even the root. One conversation's
sequence must fit into a row (2 GiB, some hundred million turns).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lauter.llm.common import text_or_empty, written

DIGEST = 16
BLOCK_ROWS = 1 << 16
BLOCK_TURNS = 1 << 20
PIECE = 1 << 16
WORDS = r"[^\x20\x09-\x0D]+"

_EMPTY = hashlib.sha256(b"").hexdigest()
_PARTIAL = (
    "border boolean, depth long, conv_id long, parent_conv_id long, key binary, parent_key binary, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string"
)
_NAMES = [part.split()[0] for part in _PARTIAL.split(", ")]


# -- sequences ----------------------------------------------------------------


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of a conversation in order, each a digest and its words."""
    role, text = text_or_empty(F.col("role")), text_or_empty(F.col("text"))
    # the length of the role keeps (role, text) apart from another split of the same characters
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST)
    words = F.regexp_count(text, F.lit(WORDS)).cast("int")
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), digest.alias("digest"), words.alias("words")).alias("one"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def with_shared_heads(convs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversations whose first ``crc32(id) % (most + 1)`` turns are those of the first of
    their ``every``: what a system prompt or a retry does to real collections."""
    own = F.col("conv_id") - F.col("conv_id") % every
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    asked = convs.select("*", own.alias("base"), head.cast("int").alias("h"))
    joined = asked.join(heads.where(F.col("base") % every == 0), "base", "left")
    begin = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(begin, rest).alias("turns"))


# -- ids of equal conversations -----------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, conv_id`` to ``key, first, n, piece`` with at most ``PIECE`` ids a piece."""
    names = ["key", "first", "n", "piece"]
    last, ids = None, []

    def piece():
        return [last], [ids[0]], [len(ids)], [",".join(map(str, ids))]

    def batch(columns):
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    out = [[], [], [], []]
    for rows in batches:
        for key, conv in zip(rows["key"].to_pylist(), rows["conv_id"].to_pylist(), strict=True):
            if key != last or len(ids) >= PIECE:
                if ids:
                    for column, value in zip(out, piece(), strict=True):
                        column += value
                    if len(out[0]) >= 10_000 or len(ids) >= PIECE:
                        yield batch(out)
                        out = [[], [], [], []]
                last, ids = key, []
            ids.append(conv)
    if ids:
        for column, value in zip(out, piece(), strict=True):
            column += value
    yield batch(out)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (key, first) to ``conv_id, n, ends_sha256`` per key."""
    last, state, first, n = None, None, 0, 0
    out = []

    def batch():
        columns = list(zip(*out, strict=True)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "n", "ends_sha256"]
        )

    for rows in batches:
        for key, begin, count, piece in zip(*(rows[c].to_pylist() for c in ("key", "first", "n", "piece")), strict=True):
            if key != last:
                if state is not None:
                    out.append((first, n, state.hexdigest()))
                last, state, first, n = key, hashlib.sha256(), begin, 0
            else:
                state.update(b",")
            state.update(piece.encode())
            n += count
        if out:
            yield batch()
            out = []
    if state is not None:
        out.append((first, n, state.hexdigest()))
    yield batch()


def merged(convs: DataFrame) -> DataFrame:
    """``conv_id, n, ends_sha256`` of every distinct sequence; ``convs`` has ``key, conv_id``."""
    ordered = convs.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ordered.mapInArrow(_pieces, "key binary, first long, n long, piece string")
    together = pieces.repartition("key").sortWithinPartitions("key", "first")
    return together.mapInArrow(_hashed, "conv_id long, n long, ends_sha256 string")


# -- peeling ------------------------------------------------------------------


def common_turns(digests: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Turns that each of the sorted sequences shares with the one before; 0 for the first."""
    length = np.diff(offsets)
    shared = np.zeros(len(length), np.int64)
    alive = np.arange(1, len(length))
    depth = 0
    while len(alive):
        alive = alive[(length[alive] > depth) & (length[alive - 1] > depth)]
        here, before = digests[offsets[alive] + depth], digests[offsets[alive - 1] + depth]
        alive = alive[(here == before).all(axis=1)]
        depth += 1
        shared[alive] = depth
    return shared


def peel(block: list[tuple]) -> Iterator[dict[str, np.ndarray]]:
    """Nodes of a block of sorted distinct sequences, deepest first.

    An item is a node that survives from the depth below, or a sequence that ends here; it
    is known by its first sequence, and it starts a new node unless that sequence shares
    the depth with the one before.
    """
    conv, count, ends, seqs, words = (list(c) for c in zip(*block, strict=True))
    offsets = np.concatenate([[0], np.cumsum([len(s) // DIGEST for s in seqs])]).astype(np.int64)
    digests = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    flat_words = np.concatenate([np.asarray(w, np.int64) for w in words])
    conv, count = np.array(conv, np.int64), np.array(count, np.int64)
    length, shared = np.diff(offsets), common_turns(digests, offsets)
    last = len(seqs) - 1
    by_length = np.argsort(length, kind="stable")
    lengths = length[by_length]
    paths = {0: _keys(seqs[0]), last: _keys(seqs[last])}
    # the last path is the first one as deep as they agree, and is known by another sequence
    behind = _first_of_last_path(shared, length, last)

    below = None
    for depth in range(int(length.max()), -1, -1):
        ending = by_length[np.searchsorted(lengths, depth) : np.searchsorted(lengths, depth, side="right")]
        fresh = {
            "r": ending, "conv": conv[ending], "n": count[ending], "leaves": 0 * ending, "saved": 0 * ending,
            "end": ending, "kids": 0 * ending, "border": 0 * ending,
        }
        items = fresh
        if below is not None:
            k = len(below["r"])
            survived = {
                "r": below["r"], "conv": below["conv_id"], "n": below["n_convs"],
                # what a border node adds is only known when all its parts are
                "leaves": np.where(below["border"], 0, below["n_leaves"]),
                "saved": np.where(below["border"], 0, below["saved_tokens"]),
                "end": np.full(k, -1), "kids": np.where(below["border"], 0, 1),
                "border": below["border"].astype(np.int64),
            }
            items = {name: np.concatenate([fresh[name], survived[name]]) for name in fresh}
        order = np.argsort(items["r"], kind="stable")
        items = {name: values[order] for name, values in items.items()}
        new = shared[items["r"]] < depth
        new[0] = True
        heads = np.flatnonzero(new)
        node = {name: np.add.reduceat(items[name], heads) for name in ("n", "leaves", "saved", "kids", "border")}
        r = items["r"][heads]
        low = np.minimum.reduceat(items["conv"], heads)
        end = np.maximum.reduceat(items["end"], heads)
        text = flat_words[offsets[r] + depth - 1] if depth else 0 * r
        border = (r == 0) | (r == behind[depth]) if depth else np.ones(1, bool)
        whole = ~border
        childless = (node["kids"] == 0) & (node["border"] == 0)
        here = {
            "r": r, "border": border, "depth": np.full(len(r), depth), "conv_id": low, "n_convs": node["n"],
            "n_children": node["kids"], "n_leaves": np.where(whole & childless, 1, node["leaves"]),
            # a border node's own tokens wait for all its members
            "saved_tokens": node["saved"] + np.where(whole, (node["n"] - 1) * text, 0),
            "words": text, "end": end,
        }
        if below is not None:
            owner = np.cumsum(new)[np.argsort(order, kind="stable")][len(ending) :] - 1
            below["parent_conv_id"], below["parent_border"] = low[owner], border[owner]
            below["parent_r"] = r[owner]
            yield _rows(below, paths, last, ends)
        below = here
    below["parent_conv_id"], below["parent_border"] = np.zeros(1, np.int64), np.zeros(1, bool)
    below["parent_r"] = np.full(1, -1)
    yield _rows(below, paths, last, ends)


def _first_of_last_path(shared: np.ndarray, length: np.ndarray, last: int) -> np.ndarray:
    """Per depth, the first sequence of the node that the last sequence is in; -1 beyond it."""
    found = np.full(int(length.max()) + 1, -1, np.int64)
    at, depth = last, int(length[last])
    while depth > 0:
        while at > 0 and shared[at] >= depth:
            at -= 1
        found[depth] = at
        depth -= 1
    return found


def _keys(sequence: bytes) -> list[bytes]:
    """A hash of every prefix, the empty one first."""
    state = hashlib.sha256()
    keys = [state.digest()]
    for start in range(0, len(sequence), DIGEST):
        state.update(sequence[start : start + DIGEST])
        keys.append(state.digest())
    return keys


def _rows(nodes: dict, paths: dict, last: int, ends: list[str]) -> pa.RecordBatch:
    """Nodes of one depth; keys only where a part of the node may lie in another block."""
    depth = int(nodes["depth"][0])
    keys, parents = [], []
    for r, border, parent_border, parent_r in zip(
        nodes["r"].tolist(), nodes["border"].tolist(), nodes["parent_border"].tolist(), nodes["parent_r"].tolist(), strict=True
    ):
        keys.append(paths[0 if r == 0 else last][depth] if border else None)
        parents.append(paths[0 if parent_r == 0 else last][depth - 1] if parent_border else None)
    known = [None if depth == 0 or b else c for c, b in zip(nodes["parent_conv_id"].tolist(), nodes["parent_border"].tolist(), strict=True)]
    values = {
        "border": pa.array(nodes["border"], pa.bool_()),
        "parent_conv_id": pa.array(known, pa.int64()),
        "key": pa.array(keys, pa.binary()),
        "parent_key": pa.array(parents, pa.binary()),
        "ends_sha256": pa.array([ends[e] if e >= 0 else None for e in nodes["end"].tolist()], pa.string()),
    }
    return pa.RecordBatch.from_arrays(
        [values[name] if name in values else pa.array(nodes[name], pa.int64()) for name in _NAMES], names=_NAMES
    )


def _peeled(rows: int, turns: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("conv_id", "n", "ends_sha256", "seq", "words")), strict=True):
                block.append(row)
                held += len(row[4])
                if len(block) >= rows or held >= turns:
                    yield from peel(block)
                    block, held = [], 0
        if block:
            yield from peel(block)

    return work


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Border nodes, deepest first, with what their border children add; once per node.

    Holds what the children of nodes still to come add up to: at most as many entries as
    there are border nodes, two paths a block, whatever the rows.
    """
    names = ["key", "n_children", "n_leaves", "saved_tokens"]
    waiting: dict[bytes, list[int]] = {}
    for batch in batches:
        out = []
        columns = (batch[c].to_pylist() for c in ("key", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "words"))
        for key, parent, n, children, leaves, saved, words in zip(*columns, strict=True):
            more = waiting.pop(key, (0, 0, 0))
            children += more[0]
            leaves = leaves + more[1] if children else 1
            saved += more[2] + (n - 1) * words
            out.append((key, children, leaves, saved))
            if parent is not None:
                sums = waiting.setdefault(parent, [0, 0, 0])
                sums[0] += 1
                sums[1] += leaves
                sums[2] += saved
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def prefix_trie(convs: DataFrame, *, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per prefix of the conversations of :func:`conversations`.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    packed = convs.select(
        "conv_id",
        F.coalesce(F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")), F.lit(b"")).alias("seq"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )
    packed = written(packed.withColumn("key", F.unhex(F.sha2("seq", 256))), "conversations")
    groups = merged(packed.select("key", "conv_id"))
    distinct = packed.select("conv_id", "seq", "words").join(groups, "conv_id")
    ordered = distinct.repartitionByRange("seq").sortWithinPartitions("seq")
    parts = written(ordered.mapInArrow(_peeled(block_rows, block_turns), _PARTIAL), "trie-nodes")

    border = parts.where("border").groupBy("key").agg(
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.first("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.first("words").alias("words"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    border = written(border, "trie-border")
    # one row per border node: the number of blocks bounds them, so one task can have them
    sums = border.repartition(1).sortWithinPartitions(F.desc("depth")).mapInArrow(
        _joined, "key binary, n_children long, n_leaves long, saved_tokens long"
    )
    whole = border.drop("n_children", "n_leaves", "saved_tokens").join(sums, "key")
    mine = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    inner = parts.where("NOT border")
    nodes = inner.select(*_NAMES).unionByName(
        whole.select("*", F.lit(True).alias("border"), F.lit(None).cast("long").alias("parent_conv_id")).select(*_NAMES)
    )
    found = nodes.join(mine, "parent_key", "left")
    return found.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
