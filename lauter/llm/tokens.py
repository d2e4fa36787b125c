"""Token counts of whole texts with a public tokenizer.

Blanks and line feeds are proven stable boundaries of the word tokenizer: its pre-tokens
never hold one, lower-casing and NFC do not look across one, and no special string holds
one. So tokens on either side do not depend on each other.

* A huge text is encoded in overlapping chunks with offsets. Two neighbours are spliced
  at a boundary inside their overlap that follows such a character and at which both start
  a token. If the overlap has none it is widened, at worst to the end of the text.
* Any other text is the sum of its words between blanks, each counted by the library once
  per task and then remembered. The memory of words is emptied when full.

Each row is handled alone, so there is no shuffle and nothing that a lost executor could
take with it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LIMIT = 2_048
HUGE = 65_536
CHUNK = 32_768
OVERLAP = 512
REMEMBERED = 400_000
LONGEST_WORD = 64

STABLE = " \n"


class Counter:
    """Counts tokens of texts, without begin, end or added special tokens."""

    def __init__(self, tokenizer: Tokenizer, *, huge=HUGE, chunk=CHUNK, overlap=OVERLAP, remembered=REMEMBERED):
        self.tokenizer = tokenizer
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.huge, self.chunk, self.overlap, self.remembered = huge, chunk, overlap, remembered
        self.known: dict[str, int] = {"": 0}

    def count(self, texts: list[str]) -> list[int]:
        """Texts that are not huge together, so that new words are encoded in one call."""
        parts = [t.replace("\n", " ").split(" ") if len(t) < self.huge else None for t in texts]
        known = self.known
        if len(known) > self.remembered:
            known.clear()
            known[""] = 0
        short, long = set(), []
        for words in filter(None, parts):
            short.update(words)
        new = [w for w in short if w not in known]
        long = [w for w in new if len(w) > LONGEST_WORD]
        once = {}
        for start in range(0, len(new), 10_000):
            some = new[start : start + 10_000]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            once.update(zip(some, map(len, encoded), strict=True))
        known.update(once)
        out = [
            self.spliced(text) if words is None else sum(map(known.__getitem__, words))
            for text, words in zip(texts, parts, strict=True)
        ]
        for word in long:
            del known[word]
        return out

    def starts(self, text: str, begin: int, end: int) -> list[int]:
        encoded = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        return [begin + a for a, _ in encoded.offsets]

    def spliced(self, text: str) -> int:
        """The number of tokens, from overlapping chunks."""
        total, begin, end = 0, 0, min(self.chunk, len(text))
        here = self.starts(text, begin, end)
        since = 0  # tokens from here on are still to be counted
        while end < len(text):
            overlap = self.overlap
            while True:
                after = max(begin, end - overlap)
                until = min(len(text), after + self.chunk + overlap)
                following = self.starts(text, after, until)
                cut = self.common(text, here, following, after, end)
                if cut is not None:
                    break
                overlap *= 2
                if after == begin:  # no boundary in this chunk: take it with its successor
                    if until == len(text):
                        return total + len(following) - bisect_left(following, since)
                    end, here, overlap = until, following, self.overlap
            total += bisect_left(here, cut) - bisect_left(here, since)
            since, begin, end, here = cut, after, until, following
        return total + len(here) - bisect_left(here, since)

    @staticmethod
    def common(text: str, here: list[int], following: list[int], after: int, end: int) -> int | None:
        """The last stable boundary in [after, end) at which both start a token."""
        both = set(following)
        for start in reversed(here):
            if start <= after:
                return None
            if start < end and text[start - 1] in STABLE and start in both:
                return start
        return None


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    limit: int = LIMIT,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per input row.

    Null counts as empty text: no bytes, no tokens. Special strings inside a text count as
    the tokenizer has it by default. Other columns are not read. The tokenizer's file is
    read here and sent to the tasks: a few MB, whatever the data.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = None
        for batch in batches:
            counter = counter or Counter(Tokenizer.from_str(held.value), huge=huge, chunk=chunk, overlap=overlap)
            ids, texts = batch.columns
            for start in range(0, max(1, batch.num_rows), 1_000):
                some = texts.slice(start, 1_000).fill_null("")
                numbers = pa.array(counter.count(some.to_pylist()), pa.int64())
                sizes = pc.binary_length(some.cast(pa.binary())).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, 1_000), sizes, numbers, pc.greater(numbers, limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
