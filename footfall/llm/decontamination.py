"""Benchmark passages in training texts, found by winnowed fingerprints and extended to whole spans.

A window is 13 words. Of every 5 neighbouring 9-word grams, which 13 words span, the one with the
least hash is kept, on both sides. So a shared window has a kept gram in common, at the same place
in it, and four words around that gram on either side are enough to see the whole window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import Memo, bit_filter, passes, stage, texts_of, word_hash

WINDOW = 13
GRAM = 9
SIDE = WINDOW - GRAM
PRINTS = "array<struct<key:bigint,at:int,left:int,size:int,words:binary>>"
_PRINTS = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int32()), ("left", pa.int32()),
                              ("size", pa.int32()), ("words", pa.binary())]))

# Words are letters and figures a-z 0-9 and all characters beyond ASCII; A-Z become small.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def gram_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """A signed 64-bit key of every run of ``size`` words."""
    n = len(hashes) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i:i + n]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(29)
    return total.view(np.int64)


def winnow(keys: np.ndarray, span: int) -> np.ndarray:
    """Positions that are the last least key of some ``span`` neighbouring ones."""
    windows = np.lib.stride_tricks.sliding_window_view(keys[::-1], span)
    return np.unique(len(keys) - 1 - (np.arange(len(windows)) + windows.argmin(axis=1)))


def fingerprints(words: list[bytes], hashes: np.ndarray, item: bool, short: tuple[int, ...],
                 allowed: np.ndarray | None) -> list[tuple]:
    """Kept grams with the words around them; of short items, and for them, every gram of their size."""
    found = []

    def add(keys: np.ndarray, at: np.ndarray, size: int, side: int) -> None:
        if allowed is not None and len(at):
            at = at[passes(allowed, keys[at])]
        for i in at.tolist():
            left = min(side, i)
            found.append((int(keys[i]), i, left, size,
                          b" ".join(words[i - left:i + size + side])))

    if len(words) >= WINDOW:
        keys = gram_keys(hashes, GRAM)
        add(keys, winnow(keys, WINDOW - GRAM + 1), GRAM, SIDE)
    elif item and words:
        add(gram_keys(hashes, len(words)), np.zeros(1, np.int64), len(words), 0)
    if not item:
        for size in short:
            if len(words) >= size:
                keys = gram_keys(hashes, size)
                add(keys, np.arange(len(keys)), size, 0)
    return found


def _print_table(rows: DataFrame, id_column: str, text: str, item: bool,
                 short: tuple[int, ...] = (), allowed: np.ndarray | None = None) -> DataFrame:
    """Id, number of words and fingerprints of every row."""
    def run(batches: Iterator) -> Iterator:
        memo = Memo(word_hash)
        for batch in batches:
            counts, prints = [], []
            for value in texts_of(batch.column(1)):
                words = words_of(value)
                hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
                counts.append(len(words))
                prints.append([dict(zip(("key", "at", "left", "size", "words"), p)) for p in
                               fingerprints(words, hashes, item, short, allowed)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(prints, _PRINTS)],
                names=["id", "n_words", "prints"])

    kind = rows.schema[id_column].dataType.simpleString()
    narrow = rows.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, n_words BIGINT, prints {PRINTS}")


def extend(pairs: DataFrame) -> DataFrame:
    """Turn meeting fingerprints into shared spans of words, as ``row, item_id, first, end``.

    A pair gives a span if its grams are the same words and the run of same words around them is a
    whole window; of a short item the gram is the window.
    """
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            column = {name: batch.column(name).to_pylist() for name in
                      ("row", "item_id", "at", "left", "size", "words", "item_left", "item_words")}
            out = []
            for row, item, at, left, size, words, item_left, item_words in zip(*column.values()):
                mine, other = words.split(b" "), item_words.split(b" ")
                if mine[left:left + size] != other[item_left:item_left + size]:
                    continue
                low = 0
                while low < min(left, item_left) and mine[left - low - 1] == other[item_left - low - 1]:
                    low += 1
                a, b, high = left + size, item_left + size, 0
                while a + high < len(mine) and b + high < len(other) and mine[a + high] == other[b + high]:
                    high += 1
                if size != GRAM or low + size + high >= WINDOW or len(mine) == size == len(other):
                    out.append((row, item, at - low, at + size + high))
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], batch.column("item_id").type),
                 pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
                names=["row", "item_id", "first", "end"])

    kind = pairs.schema["item_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"row BIGINT, item_id {kind}, first INT, end INT")


def covered(spans: Column) -> Column:
    """The number of words in the union of ``first``-``end`` spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.array_sort(spans), start,
        lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"),
                              (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["first"]))
                               ).alias("n")),
        lambda a: a["n"])


def decontamination(documents: DataFrame, benchmark: DataFrame, text: str = "text",
                    item_text: str = "text") -> DataFrame:
    """Words of each document that lie in windows of benchmark items; one row per row.

    The benchmark's fingerprints become a bit map of fixed size; what passes it in the documents
    meets the benchmark in a join, so the benchmark may have any size. Null texts and texts without
    words have no words, no hits and are never contaminated. Items without words are never found; an
    item id that is null counts for hit words but not as an item, a repeated one counts once. With an
    empty benchmark every document is clean. Further columns are ignored.
    """
    items = stage(_print_table(benchmark.select("item_id", F.col(item_text).alias("text")),
                               "item_id", "text", True), "items")
    known = items.select(F.col("id").alias("item_id"), F.explode("prints").alias("p"))
    short = tuple(sorted(row[0] for row in items.filter(
        (F.col("n_words") > 0) & (F.col("n_words") < WINDOW)).select("n_words").distinct().collect()))
    allowed = bit_filter(known.select("p.key"), "key")
    found = stage(
        _print_table(documents, "doc_id", text, False, short, allowed)
        .withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    mine = found.select("row", F.explode("prints").alias("d"))
    pairs = mine.join(known, (F.col("d.key") == F.col("p.key")) & (F.col("d.size") == F.col("p.size")))
    spans = extend(pairs.select(
        "row", "item_id", "d.at", "d.left", "d.size", "d.words",
        F.col("p.left").alias("item_left"), F.col("p.words").alias("item_words")))
    hits = spans.groupBy("row").agg(
        covered(F.collect_set(F.struct("first", "end"))).alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    result = found.select("row", F.col("id").alias("doc_id"), "n_words").join(hits, "row", "left")
    return result.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        ((F.coalesce("n_hit", F.lit(0)) > 0) & (20 * F.coalesce("n_hit", F.lit(0)) >= F.col("n_words"))
         ).alias("contaminated"))
