"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max index.

Learning, on at most ``TOXIC`` + ``CLEAN`` labelled documents chosen by a hash of the id:
terms are words and beginnings of words; those that toxic examples hold significantly more
often (G-squared) make the vocabulary. How many documents hold a term is counted over all
documents.

The index holds the examples in blocks of 64, with each term's largest weight per block.
A document's nearest examples are found by visiting blocks in order of their bound, the
sum of the document's weights times those maxima, until no block can reach the k-th best;
documents are looked up many at a time, and those that visit the same block share the work:
the same neighbours as comparing with every example. Neighbours vote with their cosine,
each class weighted back to its share among the labelled, against a prior, which is the
share of toxic examples without any term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lauter.llm.common import crc_mod, written

TOXIC = 4_000
CLEAN = 16_000
SUPPORT = 5
SIGNIFICANCE = 30.0
MOST_TERMS = 8_192
PREFIXES = range(3, 7)
NEIGHBOURS = 15
PRIOR_WEIGHT = 0.25
BLOCK = 64
ROUNDS = 4
WIDER = 4
TOGETHER = 256
THRESHOLD = 0.5
REMEMBERED = 500_000

_KEEP = b"abcdefghijklmnopqrstuvwxyz"
_BLANKS = bytes(c if c >= 128 or c in _KEEP else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of letters (of anything outside ASCII)."""
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANKS).split()


def terms_of(word: bytes) -> list[str]:
    name = word.decode("utf-8", "replace")
    return [name, *(name[:k] + "*" for k in PREFIXES if len(name) >= k)]


class Vocabulary:
    """Counts of vocabulary terms in a text."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def counts(self, text: str | None) -> dict[int, int]:
        found: dict[int, int] = {}
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word, n in Counter(words_of(text)).items():
            terms = known.get(word)
            if terms is None:
                terms = tuple(self.number[t] for t in terms_of(word) if t in self.number)
                known[word] = terms
            for term in terms:
                found[term] = found.get(term, 0) + n
        return found


@dataclass
class Counts:
    """Term counts of texts: those of text ``i`` lie from ``first[i]`` to ``first[i + 1]``, by term."""

    first: np.ndarray
    terms: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, found: list[dict[int, int]]) -> Counts:
        rows = [sorted(f.items()) for f in found]
        flat = np.array([pair for row in rows for pair in row], np.int64).reshape(-1, 2)
        return cls(np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64), flat[:, 0], flat[:, 1])

    @classmethod
    def read(cls, column: pa.Array) -> Counts:
        """From a column ``array<struct<term, n>>`` without nulls."""
        values = column.flatten()
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        terms, n = (values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        return cls(np.append(0, np.cumsum(lengths)).astype(np.int64), terms, n)

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, rows: np.ndarray) -> Counts:
        lengths = np.diff(self.first)[rows]
        first = np.append(0, np.cumsum(lengths)).astype(np.int64)
        at = np.arange(first[-1]) + np.repeat(self.first[:-1][rows] - first[:-1], lengths)
        return Counts(first, self.terms[at], self.n[at])

    def key(self, row: int) -> bytes:
        part = slice(self.first[row], self.first[row + 1])
        return self.terms[part].tobytes() + self.n[part].tobytes()

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def weights(self, idf: np.ndarray) -> np.ndarray:
        """TF-IDF of every count, of length 1 together in each text."""
        found = (1 + np.log(self.n)) * idf[self.terms]
        length = np.sqrt(np.bincount(self.rows(), found * found, len(self)))
        return found / np.maximum(length, 1e-12)[self.rows()]


def _ranks(groups: np.ndarray) -> np.ndarray:
    """The place of each within its group, for groups in order."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups)


class BlockMaxIndex:
    """Examples in blocks, with the largest weight of each term in each block.

    Queries come many at a time. Each visits blocks in order of its own bounds; queries
    that visit the same block in a round do so together, in one matrix product over the
    terms that the block holds.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.size, self.block, self.n_terms = len(vectors), block, n_terms
        self.n_blocks = -(-self.size // block)
        self.first = np.append(0, np.cumsum([len(t) for t, _ in vectors])).astype(np.int64)
        self.rows = np.repeat(np.arange(self.size), np.diff(self.first))
        self.terms = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)])
        self.weights = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        self.max = np.zeros((self.n_terms, self.n_blocks))
        np.maximum.at(self.max, (self.terms, self.rows // block), self.weights)
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"blocks": {}}  # tasks lay them out again, so that less is sent

    def _block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a block and its examples' weights for them, one row per example."""
        if number not in self.blocks:
            part = slice(*self.first[[number * self.block, min((number + 1) * self.block, self.size)]])
            terms, place = np.unique(self.terms[part], return_inverse=True)
            laid = np.zeros((min(self.block, self.size - number * self.block), len(terms)), np.float32)
            laid[self.rows[part] - number * self.block, place] = self.weights[part]
            self.blocks[number] = terms, laid
        return self.blocks[number]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k examples of largest cosine above 0, ties by number, largest first."""
        return self.nearest_of_each(1, np.zeros(len(terms), np.int64), terms, weights, k)[0]

    def nearest_of_each(
        self, many: int, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int
    ) -> list[list[tuple[float, int]]]:
        """The k nearest examples of each of ``many`` queries, whose numbers are ``rows``.

        A round visits ``WIDER`` times as many blocks as the one before, the last all that
        are left; none whose bound is below the k-th best of the rounds before.
        """
        held = np.zeros((self.n_terms, many))
        held[terms, rows] = weights
        bounds = held.T @ self.max
        short = held.astype(np.float32)
        order = np.argsort(-bounds, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(self.n_blocks)[None, :], axis=1)
        least = np.zeros(many)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]  # query, example, cosine
        start, stop = 0, 1
        for last in (False,) * ROUNDS + (True,):
            stop = self.n_blocks if last else stop
            # a little below the k-th best, so that ties are told apart by number
            wanted = (place >= start) & (place < stop) & (bounds > 0) & (bounds >= (least - 1e-11)[:, None])
            q, e = self._scores(np.flatnonzero(wanted.any(axis=0)), wanted, short, least, k)
            cosines = self._exact(q, e, held)
            found = [np.append(a, b) for a, b in zip(found, (q, e, cosines), strict=True)]
            best = np.lexsort((found[1], -found[2], found[0]))
            best = best[found[2][best] > 0]
            rank = _ranks(found[0][best])
            best, rank = best[rank < k], rank[rank < k]
            found = [column[best] for column in found]
            least[found[0][rank == k - 1]] = found[2][rank == k - 1]
            start, stop = stop, stop * WIDER
        ends = np.searchsorted(found[0], np.arange(many + 1))
        pairs = list(zip(found[2].tolist(), found[1].tolist(), strict=True))
        return [pairs[a:b] for a, b in zip(ends, ends[1:])]

    def _scores(
        self, blocks: np.ndarray, wanted: np.ndarray, short: np.ndarray, least: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Queries and examples of the blocks they want that can be among their k nearest.

        Products of single precision choose them. Vectors have length 1, so such a sum of n
        terms is off by less than n + 2 rounding errors, and what is below the k-th best by
        twice as much is not among the best.
        """
        off = (min(self.n_terms, int(np.diff(self.first).max(initial=0)) * self.block) + 2) * np.finfo(np.float32).eps
        floor = (least - off).astype(np.float32)
        queries, examples, nears = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        for number in blocks.tolist():
            some = np.flatnonzero(wanted[:, number])
            terms, laid = self._block(number)
            near = (laid @ short[terms][:, some]).T
            q, e = np.nonzero((near > 0) & (near >= floor[some][:, None]))
            queries.append(some[q])
            examples.append(number * self.block + e)
            nears.append(near[q, e])
        q, e, near = (np.concatenate(c) for c in (queries, examples, nears))
        best = np.lexsort((-near, q))
        rank = _ranks(q[best])
        edge = np.zeros(len(least), np.float32)
        at_edge = best[rank == k - 1]
        edge[q[at_edge]] = near[at_edge] - np.float32(2 * off)
        some = np.flatnonzero(near >= edge[q])
        return q[some], e[some]

    def _exact(self, queries: np.ndarray, examples: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Cosines of pairs, to 12 places, from the examples' postings."""
        lengths = np.diff(self.first)[examples]
        ends = np.cumsum(lengths)
        at = np.arange(lengths.sum()) + np.repeat(self.first[:-1][examples] - ends + lengths, lengths)
        pair = np.repeat(np.arange(len(queries)), lengths)
        return np.round(np.bincount(pair, self.weights[at] * held[self.terms[at], queries[pair]], len(queries)), 12)


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    index: BlockMaxIndex
    toxic: np.ndarray  # per example of the index
    weight: np.ndarray  # per example: labelled documents it stands for
    ids: np.ndarray
    prior: float
    neighbours: int

    def scores(self, texts: Counts, memory: dict) -> tuple[list[float], list[list[int]]]:
        """Scores and the ids of the nearest examples; equal counts are looked up once."""
        keys = [texts.key(i) for i in range(len(texts))]
        if len(memory) > REMEMBERED // 5:
            memory.clear()
        fresh = {k: i for i, k in enumerate(keys) if k not in memory}
        rows = np.fromiter(fresh.values(), np.int64, len(fresh))
        for start in range(0, len(rows), TOGETHER):
            some = rows[start : start + TOGETHER]
            part = texts.take(some)
            near = self.index.nearest_of_each(len(part), part.rows(), part.terms, part.weights(self.idf), self.neighbours)
            memory.update((keys[i], self._vote(n)) for i, n in zip(some, near, strict=True))
        found = [memory[k] for k in keys]
        return [s for s, _ in found], [e for _, e in found]

    def _vote(self, near: list[tuple[float, int]]) -> tuple[float, list[int]]:
        if not near:
            return self.prior, []
        at = [i for _, i in near]
        votes = np.array([s for s, _ in near]) * self.weight[at]
        least = PRIOR_WEIGHT * float(self.weight.min())
        score = (float(votes @ self.toxic[at]) + least * self.prior) / (float(votes.sum()) + least)
        return min(max(score, 0.0), 1.0), [int(i) for i in self.ids[at]]


def _counted(batches: Iterator[pa.RecordBatch], wanted: set[str] | None) -> Iterator[pa.RecordBatch]:
    """Number of texts with each term, per batch; of the wanted terms if given."""
    known: dict[bytes, list[str]] = {}
    for batch in batches:
        held: Counter = Counter()
        for text in batch.column(0).to_pylist():
            own: set[str] = set()
            for word in set(words_of(text)):
                terms = known.get(word)
                if terms is None:
                    terms = [t for t in terms_of(word) if wanted is None or t in wanted]
                    if len(known) < REMEMBERED:
                        known[word] = terms
                own.update(terms)
            held.update(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["term", "n"]
        )


def _g2(a: Column, b: Column, n1: int, n0: int) -> Column:
    """Twice the log-likelihood gained by one rate per class instead of one rate for both."""

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    rate = (a + b) / F.lit(float(n1 + n0))
    return 2 * (
        part(a, rate * n1) + part(b, rate * n0)
        + part(n1 - a, (1 - rate) * n1) + part(n0 - b, (1 - rate) * n0)
    )


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic: int, clean: int):
    """Texts of the chosen examples, and how many were labelled per class."""
    given = labels.where("i IS NOT NULL AND y IS NOT NULL").groupBy("i").agg(F.max("y").alias("y"))
    given = docs.select(F.col(id_col).alias("i")).distinct().join(given, "i")
    numbers = {r["y"]: r["n"] for r in given.groupBy("y").agg(F.count("*").alias("n")).collect()}
    most = F.when(F.col("y") == 1, toxic).otherwise(clean)
    given = given.withColumn("bucket", F.shiftright(F.xxhash64("i"), 52))
    # whole buckets of the hash are in or out by their counts; only those up to the bound are ranked
    cells = given.groupBy("y", "bucket").agg(F.count("*").alias("held"))
    upto = Window.partitionBy("y").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("before", F.sum("held").over(upto) - F.col("held")).where(F.col("before") < most)
    chance = Window.partitionBy("y", "bucket").orderBy(F.xxhash64("i"), "i")
    picked = given.join(cells, ["y", "bucket"]).withColumn("r", F.col("before") + F.row_number().over(chance))
    picked = picked.where(F.col("r") <= most).select("i", "y")
    plain = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    # at most toxic + clean rows of two numbers
    rows = written(plain.join(F.broadcast(picked), "i"), "examples")
    return rows, numbers


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    *,
    toxic: int = TOXIC,
    clean: int = CLEAN,
    support: int = SUPPORT,
    significance: float = SIGNIFICANCE,
    neighbours: int = NEIGHBOURS,
) -> tuple[Model, DataFrame]:
    """The model, and ``i, counts`` (terms of the vocabulary) for every row of ``docs``.

    Labels other than 0 and 1, null labels and null ids are not learned from; of several
    labels of one document the largest counts. Without labels every score is 0.
    """
    spark = docs.sparkSession
    pairs = labels.select(F.col("doc_id").alias("i"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    examples, numbers = _sample(docs, pairs, id_col, text_col, toxic, clean)
    held = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = held.get(1, 0), held.get(0, 0)

    def count(frame: DataFrame, wanted: set[str] | None = None) -> DataFrame:
        sent = spark.sparkContext.broadcast(wanted)
        found = frame.mapInArrow(lambda batches: _counted(batches, sent.value), "term string, n long")
        return found.groupBy("term").agg(F.sum("n").alias("n"))

    often = count(examples.where("y = 1").select("t")).where(F.col("n") >= support)
    often = written(often.withColumnRenamed("n", "a"), "toxic-terms")
    # bounded by the toxic examples' terms / support
    wanted = {r["term"] for r in often.select("term").toLocalIterator()}
    rest = count(examples.where("y = 0").select("t"), wanted).withColumnRenamed("n", "b")
    a, b = F.col("a"), F.coalesce(F.col("b"), F.lit(0))
    both = often.join(rest, "term", "left").withColumn("g2", _g2(a, b, n1, n0))
    chosen = both.where((F.col("g2") >= significance) & (a * max(n0, 1) > b * max(n1, 1)))
    chosen = chosen.orderBy(F.desc("g2"), "term").limit(MOST_TERMS).select("term").collect()
    terms = sorted(r["term"] for r in chosen)

    sent = spark.sparkContext.broadcast(terms)
    vectors = written(
        docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).mapInArrow(
            lambda batches: _vectors(batches, Vocabulary(sent.value)),
            f"i {docs.schema[id_col].dataType.simpleString()}, counts array<struct<term:int,n:int>>",
        ),
        "vectors",
    )
    total = vectors.count()
    held_terms = vectors.select("counts.term").mapInArrow(_term_counts, "term int, df long")
    holding = held_terms.groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(terms))
    for r in holding.collect():  # one row per term of the vocabulary
        df[r["term"]] = r["df"]
    idf = np.log1p(total / np.maximum(df, 1))
    return _model(examples, terms, idf, numbers, held, neighbours), vectors


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = Counts.of([vocabulary.counts(t.as_py()) for t in batch.column(1)])
        columns = [pa.array(c.astype(np.int32)) for c in (found.terms, np.minimum(found.n, 2**31 - 1))]
        counts = pa.ListArray.from_arrays(found.first.astype(np.int32), pa.StructArray.from_arrays(columns, ["term", "n"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), counts], names=["i", "counts"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a task hold each term; a document has a term once."""
    held = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64), minlength=len(held))
        found[: len(held)] += held
        held = found
    terms = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(held[terms], pa.int64())], names=["term", "df"])


def _model(examples: DataFrame, terms, idf, numbers, held, neighbours) -> Model:
    # at most TOXIC + CLEAN examples, and only those with terms
    sent = examples.sparkSession.sparkContext.broadcast(terms)

    def vectors(batches):
        for batch in batches:
            own = next(_vectors(iter([batch.select(["i", "t"])]), vocabulary := Vocabulary(sent.value)))
            del vocabulary
            yield pa.RecordBatch.from_arrays([*own.columns, batch.column("y")], names=["i", "counts", "y"])

    kind = examples.schema["i"].dataType.simpleString()
    found = examples.mapInArrow(vectors, f"i {kind}, counts array<struct<term:int,n:int>>, y int")
    # columns, not rows: the driver holds a few numbers per term of an example
    rows = found.where(F.size("counts") > 0).toArrow().combine_chunks()
    y, ids = (rows.column(c).to_numpy() for c in ("y", "i"))
    with_terms = {k: int((y == k).sum()) for k in (0, 1)}
    share = {k: numbers.get(k, 0) / max(held.get(k, 0), 1) for k in (0, 1)}
    without = {k: (held.get(k, 0) - with_terms[k]) * share[k] for k in (0, 1)}
    # rule of succession on the examples without a term
    prior = (without[1] + 0.5) / (without[0] + without[1] + 1) if held else 0.0
    counts = rows.column("counts").combine_chunks()
    counts = Counts.read(counts.chunk(0) if isinstance(counts, pa.ChunkedArray) else counts)
    # similar examples side by side, so that the bounds of blocks are tight
    names = [counts.terms[a:b].astype(">i4").tobytes() for a, b in zip(counts.first, counts.first[1:])]
    order = np.array(sorted(range(len(y)), key=lambda i: (names[i], y[i], ids[i])), np.int64)
    counts = counts.take(order)
    weights = counts.weights(idf)
    vectors = [(counts.terms[a:b], weights[a:b]) for a, b in zip(counts.first, counts.first[1:])]
    return Model(
        terms, idf, BlockMaxIndex(vectors, len(terms)), y[order].astype(float),
        np.array([share[k] for k in y[order].tolist()]), ids[order], float(prior), neighbours,
    )


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, score, predicted, evidence``, one row per row of ``docs``.

    ``evidence`` are the ids of the nearest labelled examples, nearest first. Null text
    counts as empty; texts without a term of the vocabulary get the prior.
    """
    model, vectors = fit(docs, labels, id_col, text_col, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            scores, evidence = sent.value.scores(Counts.read(batch.column(1)), memory)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                    pa.array(evidence, pa.list_(pa.int64())),
                ],
                names=["doc_id", "score", "predicted", "evidence"],
            )

    kind = vectors.schema["i"].dataType.simpleString()
    return vectors.mapInArrow(score, f"doc_id {kind}, score double, predicted int, evidence array<long>")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model, _ = fit(docs, labels, id_col, text_col, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        vocabulary = Vocabulary(sent.value.terms)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            found = Counts.of([vocabulary.counts(t.as_py()) for t in texts])
            scores, _ = sent.value.scores(found, memory)
            yield batch.filter(pa.array([s < THRESHOLD for s in scores], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def learnable(labels: DataFrame, modulus: int = 5) -> DataFrame:
    """Labels of documents that are not held out: crc32 of the id as text, modulo, is not 0."""
    return labels.where(crc_mod(F.col("doc_id"), modulus) != 0)
