"""Language model scores of whole texts by a hidden Markov model trained on the corpus.

The model emits symbols: the most used words are symbols of their own, every other word is a symbol by
its shape, and the end of a text is one. Of the words of one shape each has its share by its own count, so
every word has a probability of its own, whatever the number of words. Counts of the most used words are
known to every task; the others are joined.

Training counts words once, encodes all texts once, and then sums up Baum-Welch counts over all training
texts, once per round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import stage
from footfall.llm.frequent import frequent
from footfall.llm.hidden_markov import Counts, HiddenMarkov

#: Words with a symbol of their own, and words whose counts every task knows, at most.
OWN_SYMBOLS, KNOWN_WORDS = 16_384, 262_144
STATES, ROUNDS, SEED = 8, 4, 1
#: A word is never empty, so the empty one stands for the end of a text.
END = b""
#: Shapes: words ending in each small letter, in a figure, in another ASCII character, in none of those.
SHAPES = 29
#: Training texts are all but those of this remainder.
FOLDS, HELD_OUT = 5, 1
#: Bytes of text that are split at a time (or one text), and of words that are counted at a time.
PIECE_BYTES, POOL_BYTES = 1 << 24, 1 << 25
POOL_SYMBOLS = 1 << 22


def pieces(batches: Iterator, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of ids and texts in parts of bounded bytes (or one text), null texts as empty ones."""
    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.binary()), b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, end - at), texts.slice(at, end - at)], names=["doc_id", "text"])
            at = end


def words_of(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of texts one after another with A-Z small, and how many each text has; words end at
    ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    parts, number = lists.flatten().view(pa.binary()), pc.list_value_length(lists).to_numpy()
    if not len(parts):
        return parts, number.astype(np.int64)
    filled = pc.binary_length(parts).to_numpy() > 0  # white space at either end leaves an empty part
    return parts.filter(pa.array(filled)), np.add.reduceat(filled, np.cumsum(number) - number, dtype=np.int64)


def shape(word: bytes) -> int:
    """The shape of a word, by its last byte."""
    last = word[-1]
    if 97 <= last <= 122:
        return last - 97
    return 26 if 48 <= last <= 57 else 27 if last < 128 else 28


SHAPE_OF = np.array([shape(bytes([last])) for last in range(256)], np.uint16)


def shapes(words: pa.BinaryArray) -> np.ndarray:
    """The shape of each word."""
    if not len(words):
        return np.zeros(0, np.uint16)
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset)[1:]
    return SHAPE_OF[np.frombuffer(data, np.uint8)[ends - 1]]


def is_held_out(doc_id: object) -> bool:
    """Whether a document is kept from training; a null id counts as an empty one."""
    name = "" if doc_id is None else str(doc_id)
    return zlib.crc32(name.encode()) % FOLDS == HELD_OUT


# --- words ------------------------------------------------------------------------------------

def word_counts(documents: DataFrame, pool_bytes: int = POOL_BYTES) -> DataFrame:
    """Every token of the training texts with its shape and count; the end is the word ``END``."""
    def run(batches: Iterator) -> Iterator:
        def rows(words: pa.BinaryArray, shapes: np.ndarray, n: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [words, pa.array(shapes, pa.int32()), n], names=["word", "shape", "n"])

        def counted() -> pa.RecordBatch:
            found = pa.chunked_array(pool, pa.binary()).value_counts()
            return rows(found.field("values"), shapes(found.field("values")), found.field("counts"))

        ends, pool = 0, []
        for piece in pieces(batches):
            learnt = pa.array([not is_held_out(doc_id) for doc_id in piece.column(0).to_pylist()], pa.bool_())
            texts = piece.column(1).filter(learnt)
            pool.append(words_of(texts)[0])
            ends += len(texts)
            if sum(words.nbytes for words in pool) >= pool_bytes:
                yield counted()
                pool.clear()
        yield counted()
        yield rows(pa.array([END][:ends], pa.binary()), [SHAPES][:ends], pa.array([ends][:ends], pa.int64()))

    found = documents.mapInArrow(run, "word BINARY, shape INT, n BIGINT")
    return found.groupBy("word", "shape").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What tasks know of the training words: symbols, counts, and the totals of the shapes.

    Symbols are numbered: the shapes, then the end, then the words with a symbol of their own.
    """

    tokens: int
    distinct: int
    symbols: dict[bytes, int]
    counts: dict[bytes, int]
    #: Log10 of what counts plus a half are divided by: for the base score, and per shape.
    base: float
    by_shape: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, own_symbols: int = OWN_SYMBOLS, known_words: int = KNOWN_WORDS
           ) -> "Lexicon":
        """The lexicon of staged ``word_counts``. The driver sees ``known_words`` rows at most, and one
        row per shape."""
        totals = {row["shape"]: (row["n"], row["words"]) for row in counts.groupBy("shape").agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()}
        ends, _ = totals.pop(SHAPES, (0, 0))
        found = frequent(counts.filter(F.col("shape") < SHAPES), "n", known_words)
        rows = sorted(zip(found["word"].to_pylist(), found["shape"].to_pylist(), found["n"].to_pylist()),
                      key=lambda row: (-row[2], row[0]))
        used, words = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for number, (n, kinds) in totals.items():
            used[number], words[number] = n, kinds
        tokens, distinct = int(used.sum()) + ends, int(words.sum()) + (ends > 0)
        own = rows[:own_symbols]
        for _, number, n in own:
            used[number] -= n
            words[number] -= 1
        uses = np.concatenate([used, [ends], np.array([n for *_, n in own], np.int64)]) + 0.5
        symbols = {END: SHAPES} | {word: SHAPES + 1 + i for i, (word, *_) in enumerate(own)}
        return cls(tokens, distinct, symbols, {END: ends} | {word: n for word, _, n in rows},
                   float(np.log10(tokens + 0.5 * (distinct + 1))),
                   np.log10(used + 0.5 * (words + 1)), uses / uses.sum())


# --- encoded texts ----------------------------------------------------------------------------

ENCODED = ("row BIGINT, {id}, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, "
           "inner_score DOUBLE, codes BINARY, words ARRAY<BINARY>, uses ARRAY<INT>")


class Encoder:
    """Texts as symbols, with what the scores owe to counts. ``codes`` are 16-bit numbers.

    Known words are numbered, then come the end and all other words; per number there are a symbol, the
    logarithm of the count, and what the word's share of its shape adds.
    """

    def __init__(self, lexicon: Lexicon):
        words = [word for word in lexicon.counts if word != END]
        self.words, self.end, self.other = pa.array(words, pa.binary()), len(words), len(words) + 1
        self.tokens, self.base, self.by_shape = lexicon.tokens, lexicon.base, lexicon.by_shape
        own = np.array([lexicon.symbols.get(word, -1) for word in words], np.int64)
        shape = shapes(self.words)
        uses = np.array([lexicon.counts[word] for word in [*words, END]], np.float64)
        self.logs = np.append(np.log10(uses + 0.5), 0.0)
        self.symbols = np.append(np.where(own < 0, shape, own), [SHAPES, 0]).astype(np.uint16)
        inner = np.where(own < 0, self.logs[:self.end] - self.by_shape[shape], 0.0)
        self.inner = np.append(inner, [0.0, 0.0])

    def encode(self, texts: pa.BinaryArray) -> list[pa.Array]:
        """Per text: tokens, known ones, base and inner score as far as known here, symbols, and the words
        that are not known here with their numbers."""
        words, number = words_of(texts)
        n, nth = number + 1, np.repeat(np.arange(len(texts)), number)
        ends = np.cumsum(n) - 1
        starts, places = ends - number, np.arange(len(words)) + nth
        at = np.full(int(n.sum()), self.end, np.int32)
        at[places] = pc.fill_null(pc.index_in(words, value_set=self.words), self.other).to_numpy()
        codes, inner = self.symbols[at], self.inner[at]
        base = np.add.reduceat(self.logs[at], starts) if len(n) else np.zeros(0)

        unknown = at[places] == self.other
        others = words.filter(pa.array(unknown, pa.bool_())).dictionary_encode()
        number_of, shape = others.indices.to_numpy(), shapes(others.dictionary)
        codes[places[unknown]] = shape[number_of]
        inner[places[unknown]] = -self.by_shape[shape[number_of]]
        kinds = max(1, len(others.dictionary))
        found, uses = np.unique(nth[unknown] * kinds + number_of, return_counts=True)
        first = pa.array(np.searchsorted(found, np.arange(len(n) + 1) * kinds), pa.int32())
        known = n - np.bincount(nth[unknown], minlength=len(n)) if self.tokens else 0 * n
        cuts = np.append(0, 2 * (ends + 1)).astype(np.int32)
        return [pa.array(n), pa.array(known), pa.array(base - n * self.base),
                pa.array(np.add.reduceat(inner, starts) if len(n) else np.zeros(0)),
                pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(cuts), pa.py_buffer(codes)]),
                pa.ListArray.from_arrays(first, others.dictionary.take(pa.array(found % kinds))),
                pa.ListArray.from_arrays(first, pa.array(uses, pa.int32()))]


def encoded(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All documents as symbols, staged; ``words`` and ``uses`` are what remains to be joined."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    encoder = Encoder(lexicon)

    def run(batches: Iterator) -> Iterator:
        row = TaskContext.get().partitionId() << 33
        for piece in pieces(batches):
            ids, rows = piece.column(0), piece.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + rows), pa.int64()), ids,
                 pa.array([is_held_out(doc_id) for doc_id in ids.to_pylist()], pa.bool_()),
                 *encoder.encode(piece.column(1))],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner_score",
                       "codes", "words", "uses"])
            row += rows

    return stage(documents.mapInArrow(run, ENCODED.format(id=f"doc_id {kind}")), "encoded")


def _pools(batches: Iterator, column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The symbols of each batch in pools of bounded size (or one text), with their rows."""
    for batch in batches:
        first, size, pool = 0, 0, []
        values = batch.column(column)
        for i in range(len(values)):
            pool.append(np.frombuffer(values[i].as_buffer(), np.uint16))
            size += len(pool[-1])
            if size >= POOL_SYMBOLS or i == len(values) - 1:
                yield batch.slice(first, i + 1 - first), pool
                first, size, pool = i + 1, 0, []


# --- the model --------------------------------------------------------------------------------

def train(texts: DataFrame, lexicon: Lexicon, states: int = STATES, rounds: int = ROUNDS,
          seed: int = SEED) -> HiddenMarkov:
    """The model after ``rounds`` rounds of Baum-Welch over all training texts among ``encoded`` ones.

    Every task adds up its expected counts; Spark adds up those of all tasks, a row per symbol, so the
    driver sees as many rows as there are symbols and states.
    """
    model = HiddenMarkov.fresh(lexicon.share, states, seed)
    symbols = len(lexicon.share)
    names = [f"k{k}" for k in range(states)]
    chosen = texts.filter("NOT held_out").select("codes")
    for _ in range(rounds):
        def run(batches: Iterator, model: HiddenMarkov = model) -> Iterator:
            total = np.zeros((symbols + states + 1, states))
            for _, pool in _pools(batches, 0):
                counts = model.expected_counts(pool)
                total[:symbols] += counts.emit
                total[symbols:-1] += counts.follow
                total[-1] += counts.start
            used = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), *(pa.array(total[used, k]) for k in range(states))],
                names=["place", *names])

        parts = chosen.mapInArrow(run, ", ".join(["place INT", *(f"{n} DOUBLE" for n in names)]))
        found = parts.groupBy("place").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
        total = np.zeros((symbols + states + 1, states))
        total[found["place"].to_numpy()] = np.array([found[n].to_numpy() for n in names]).T
        model = model.next(Counts(total[-1], total[symbols:-1], total[:symbols]), lexicon.share)
    return model


def scores(texts: DataFrame, model: HiddenMarkov) -> DataFrame:
    """``encoded`` texts with the model's log10 probability of their symbols in place of the symbols."""
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner_score"]
    fields = [f for f in texts.schema if f.name in kept]

    def run(batches: Iterator) -> Iterator:
        for part, pool in _pools(batches, len(kept)):
            logs = model.log_likelihoods(pool) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(kept)], pa.array(logs)], names=[*kept, "symbol_score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return texts.select(*kept, "codes").mapInArrow(run, f"{schema}, symbol_score DOUBLE")


def joined_words(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """Per row of ``encoded`` with words that tasks do not know: what these add to its scores."""
    words = texts.filter(F.size("words") > 0).select(
        "row", F.explode(F.arrays_zip("words", "uses")).alias("entry")
    ).select("row", F.col("entry.words").alias("word"), F.col("entry.uses").alias("uses"))
    n = F.coalesce("n", F.lit(0))
    return words.join(counts.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.col("uses") * F.log10(n + 0.5)).alias("more_score"),
        F.sum(F.when(n > 0, F.col("uses")).otherwise(0)).alias("more_known"))


def lm_scoring(documents: DataFrame, states: int = STATES, rounds: int = ROUNDS, seed: int = SEED,
               own_symbols: int = OWN_SYMBOLS, known_words: int = KNOWN_WORDS, text: str = "text"
               ) -> DataFrame:
    """Base and model score of every document, the model trained on those that are not held out.

    One row per row. ``base_score`` rests on the tokens' training counts alone, ``score`` is the log10
    probability of the whole text under the model. A null text is empty and has its end only. Repeated
    rows and rows of one id are scored, and learnt from, one by one; a null id counts as an empty one.
    Without training texts no token is known, the base score is 0 and the model is that of chance over
    the shapes. An empty table gives no row; further columns are ignored.
    """
    if own_symbols + SHAPES + 1 > 1 << 16:
        raise ValueError("symbols are 16-bit numbers")
    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    counts = stage(word_counts(narrow), "word-counts")
    lexicon = Lexicon.of(counts, own_symbols, known_words)
    texts = encoded(narrow, lexicon)
    model = train(texts, lexicon, states, rounds, seed)
    more = F.coalesce("more_score", F.lit(0.0))
    return scores(texts, model).join(joined_words(texts, counts), "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("symbol_score") + F.col("inner_score") + more).alias("score"))
