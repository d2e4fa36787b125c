"""Language identification: script ranges, per-word scores and a Viterbi pass.

Learning: letter trigrams of words are counted per language over a bounded sample of
labelled documents, at most ``PER_LANGUAGE`` of each language, chosen by a hash of the id.
The model is one number per trigram and language.

Labelling: a word's script narrows the languages to those learned in that script; each
word scores the sum of its trigrams' log probabilities; a Viterbi pass with a penalty for
each switch labels every word, and the language of most letters is the document's. The
pass runs over all documents of a batch at once, one step per word position. Documents in
which no run of words can win back the penalty need no pass: one language has all words.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lauter.llm.common import crc_mod

PER_LANGUAGE = 2_000
MOST_GRAMS = 200_000  # of one language
TOGETHER = 1 << 18  # code points
SWITCH = 12.0
STRANGE = 40.0
CLOSE = 0.5  # what sums of scores may be apart and count as undecided, far above rounding
UNKNOWN = "und"

# First code points of Unicode script ranges; a range ends at the next one
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x2E80, "han"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"),
    (0xFF65, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def letter_table() -> np.ndarray:
    """Per code point: 0, or 1 if it is a letter."""
    codes = (chr(c) for c in range(sys.maxunicode + 1))
    return np.fromiter((unicodedata.category(c)[0] == "L" for c in codes), np.uint8)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def lowered(text: str) -> str:
    """Lower case of the same length, so that places stay the same."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def portions(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have some ``TOGETHER`` code points: what is made of them has tens of
    bytes per code point. A longer text is alone."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    sizes = np.cumsum(sizes.astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + TOGETHER, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


@dataclass
class Words:
    """The words of several texts, one after the other."""

    code: np.ndarray  # code points, each text preceded by a blank
    start: np.ndarray  # per word
    stop: np.ndarray
    text: np.ndarray  # number of the word's text
    offset: np.ndarray  # per text: where it begins in ``code``


def words_of(texts: list[str], letters: np.ndarray) -> Words:
    code = codes_of("".join(" " + lowered(t) for t in texts) + " ")
    offset = np.cumsum([1] + [len(t) + 1 for t in texts])
    alpha = letters[code]
    edge = np.diff(alpha.astype(np.int8))
    start, stop = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    return Words(code, start, stop, np.searchsorted(offset, start, "right") - 1, offset)


def grams_of(words: Words, letters: np.ndarray) -> np.ndarray:
    """A number for the three code points around each place (non-letters count as blanks)."""
    code = np.where(letters[words.code] == 1, words.code, 32)
    grams = np.zeros(len(code), np.int64)
    grams[1:-1] = (code[:-2] << 42) | (code[1:-1] << 21) | code[2:]
    return grams


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # sorted
    logp: np.ndarray  # one row per gram, then one for unknown grams
    allowed: np.ndarray  # script x language

    def scores(self, words: Words, letters: np.ndarray) -> np.ndarray:
        """One row per word: log probability for each language."""
        grams = grams_of(words, letters)
        inside = letters[words.code] == 1
        own = grams[inside]
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        sizes = words.stop - words.start
        firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        total = np.add.reduceat(self.logp[at], firsts, axis=0)
        script = _SCRIPT[np.searchsorted(_FIRST, words.code[words.start], "right") - 1]
        return total - STRANGE * ~self.allowed[script]


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best label per word; ``lengths`` are words per text, texts one after the other."""
    n, k = scores.shape
    labels = np.zeros(n, np.int32)
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    best_before = np.zeros(n, np.int32)
    stays = np.ones((n, k), bool)
    value = np.zeros((len(lengths), k))
    steps = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than the step
    for step in range(steps):
        rows = active[step]
        at = first[:rows] + step
        now = value[:rows]
        if step:
            best = now.max(1) - switch
            best_before[at] = now.argmax(1)
            stay = now >= best[:, None]
            stays[at] = stay
            now = np.where(stay, now, best[:, None])
        value[:rows] = now + scores[at]
    label = value.argmax(1).astype(np.int32)
    for step in range(steps - 1, -1, -1):
        rows = active[step]
        at = first[:rows] + step
        labels[at] = label[:rows]
        stay = stays[at, label[:rows]]
        label[:rows] = np.where(stay, label[:rows], best_before[at])
    return labels


def whole_language(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Per text the label that :func:`viterbi` gives to all of its words, -1 if not known.

    Beside the label that is best for the whole text, a run of words in other labels gains at
    most the sum of what each word's best other label has over it, and costs a switch. If no
    run of the text gains that much, nothing but that label is best.
    """
    label = np.full(len(lengths), -1, np.int32)
    full = np.flatnonzero(lengths)
    if not len(full) or scores.shape[1] == 1:
        return np.zeros_like(label)
    n = lengths[full]
    first = np.cumsum(n) - n
    text = np.repeat(np.arange(len(full)), n)
    total = np.add.reduceat(scores, first, axis=0)
    best = total.argmax(1)
    ahead = total.max(1)
    total[np.arange(len(full)), best] = -np.inf
    ahead = ahead - total.max(1)
    place = (np.arange(len(scores)), best[text])
    others = scores.copy()
    others[place] = -np.inf
    gain = others.max(1) - scores[place]
    # sums from each text's begin; a text lies so far below the one before it that the lowest
    # sum so far is always its own
    sums = np.cumsum(gain)
    sums -= (sums[first] - gain[first])[text]
    below = (max(sums.max(), 0) - min(sums.min(), 0) + 1) * text
    sums -= below
    rise = sums - np.minimum(np.minimum.accumulate(sums), -below)
    sure = (np.maximum.reduceat(rise, first) < switch - CLOSE) & (ahead > CLOSE)
    label[full] = np.where(sure, best, -1)
    return label


def word_labels(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """What :func:`viterbi` gives, which only sees the texts that need it."""
    whole = whole_language(scores, lengths, switch)
    labels = np.repeat(whole, lengths)
    open_ = labels < 0
    if open_.any():
        labels[open_] = viterbi(scores[open_], lengths[whole < 0], switch)
    return labels


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> Model | None:
    """The model of the labelled ``docs``; None if there are none."""
    named = docs.select(
        F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t")
    ).where("lang IS NOT NULL AND t IS NOT NULL AND i IS NOT NULL")
    chance = Window.partitionBy("lang").orderBy(F.xxhash64("i"), "i")
    picked = named.select("lang", "i").withColumn("r", F.row_number().over(chance))
    picked = picked.where(F.col("r") <= per_language).select("lang", "i").distinct()
    # at most per_language ids of each language
    sample = named.join(F.broadcast(picked), ["lang", "i"], "left_semi").select("lang", "t")
    letters = docs.sparkSession.sparkContext.broadcast(letter_table())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters.value
        for some in (some for batch in batches for some in portions(batch, 1)):
            langs = np.array(some.column(0).to_pylist(), object)
            texts = np.array(some.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                words = words_of(list(texts[langs == lang]), table)
                inside = table[words.code] == 1
                grams, n = np.unique(grams_of(words, table)[inside], return_counts=True)
                scripts, m = np.unique(
                    _SCRIPT[np.searchsorted(_FIRST, words.code[words.start], "right") - 1], return_counts=True
                )
                kind = np.repeat([0, 1], [len(grams), len(scripts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(kind), pa.string()),
                        pa.array(kind, pa.int32()),
                        pa.array(np.concatenate([grams, scripts]), pa.int64()),
                        pa.array(np.concatenate([n, m]), pa.int64()),
                    ],
                    names=["lang", "kind", "what", "n"],
                )

    counted = sample.mapInArrow(count, "lang string, kind int, what long, n long")
    counted = counted.groupBy("lang", "kind", "what").agg(F.sum("n").alias("n"))
    frequent = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "what")
    counted = counted.withColumn("r", F.row_number().over(frequent)).where(F.col("r") <= MOST_GRAMS).toPandas()
    languages = sorted(set(counted["lang"]))
    if not languages:
        return None
    column = counted["lang"].map(languages.index).to_numpy()
    is_gram = (counted["kind"] == 0).to_numpy()
    what, n = counted["what"].to_numpy(), counted["n"].to_numpy()
    grams, place = np.unique(what[is_gram], return_inverse=True)
    counts = np.zeros((len(grams) + 1, len(languages)))
    counts[place, column[is_gram]] = n[is_gram]
    logp = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(counts)))
    seen = np.zeros((len(SCRIPT_NAMES), len(languages)))
    seen[what[~is_gram], column[~is_gram]] = n[~is_gram]
    allowed = seen >= 0.01 * seen.sum(0)
    allowed |= ~allowed.any(1)[:, None]  # a script of no language leaves all open
    return Model(languages, grams, logp, allowed)


def label_languages(
    docs: DataFrame,
    train: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    per_language: int = PER_LANGUAGE,
    switch: float = SWITCH,
) -> DataFrame:
    """``doc_id, lang_pred, score, spans``, one row per row of ``docs``.

    ``train`` holds labelled rows; rows without id, label or text are not learned from.
    ``spans`` are runs of words of one language, [start, stop) in code points; ``score`` is
    the predicted language's share of the letters. Null text, text without a letter, and
    any text if nothing was learned give ``und``, score 0 and no spans.
    """
    model = learn(train, id_col, text_col, lang_col, per_language)
    spark = docs.sparkSession
    # at most MOST_GRAMS rows for each language, and one byte per code point
    held = spark.sparkContext.broadcast((model, letter_table()))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = held.value
        for batch in batches:
            for some in portions(batch, 1):
                texts = [t or "" for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *_labelled(texts, model, letters, switch)],
                    names=["doc_id", "lang_pred", "score", "spans"],
                )

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    span = "struct<start:long,stop:long,lang:string>"
    return plain.mapInArrow(label, f"doc_id {kind}, lang_pred string, score double, spans array<{span}>")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))


def _labelled(texts: list[str], model: Model | None, letters: np.ndarray, switch: float) -> list[pa.Array]:
    words = words_of(texts, letters)
    n = len(texts)
    if model is None or not len(words.start):
        spans = pa.array([[] for _ in texts], _SPANS)
        return [pa.array([UNKNOWN] * n), pa.array(np.zeros(n)), spans]
    lengths = np.bincount(words.text, minlength=n)
    labels = word_labels(model.scores(words, letters), lengths, switch)
    k = len(model.languages)
    weight = np.bincount(words.text * k + labels, words.stop - words.start, n * k).reshape(n, k)
    total = weight.sum(1)
    best = weight.argmax(1)
    names = np.array([*model.languages, UNKNOWN], object)[np.where(total > 0, best, len(model.languages))]
    score = weight[np.arange(n), best] / np.maximum(total, 1)
    new = np.ones(len(labels), bool)
    new[1:] = (words.text[1:] != words.text[:-1]) | (labels[1:] != labels[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(labels)) - 1
    owner = words.text[first]
    struct = pa.StructArray.from_arrays(
        [
            pa.array(words.start[first] - words.offset[owner]),
            pa.array(words.stop[last] - words.offset[owner]),
            pa.array(np.array(model.languages, object)[labels[first]], pa.string()),
        ],
        names=["start", "stop", "lang"],
    )
    bounds = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(bounds), struct)
    return [pa.array(names, pa.string()), pa.array(score), spans]


def learnable(docs: DataFrame, id_col: str, modulus: int, held_out: int) -> DataFrame:
    """The rows that may be learned from: crc32 of the id as text, modulo, is another."""
    return docs.where(crc_mod(F.col(id_col), modulus) != held_out)
