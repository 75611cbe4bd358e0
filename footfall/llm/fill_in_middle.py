"""Fill-in-middle: texts cut at unit boundaries and put in prefix-suffix-middle order.

Units and cuts are found in bytes, while cuts are reported in code points. Between the two stands an
index of exceptions only: where the characters of more than one byte are, and how many bytes they have
too many. Between two of them, and in a text without any, a place in bytes and one in code points differ
by a constant.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import smaller, texts_of

MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN_FROM, SPM_BELOW = 90, 20


class ExceptionIndex:
    """Code-point positions of the multibyte characters of a text, and the excess bytes up to each."""

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        kind = data[lead]
        excess = 1 + (kind >= 0xE0).astype(np.int64) + (kind >= 0xF0)
        #: ``before[i]``: excess bytes of the first ``i`` exceptions.
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.bytes = lead
        self.chars = lead - self.before[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """The code-point positions of byte positions, which must not lie inside a character."""
        return cuts - self.before[np.searchsorted(self.bytes, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """The byte positions of code-point positions."""
        return cuts + self.before[np.searchsorted(self.chars, cuts)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Where units begin: at each run of ASCII letters, and at every other character."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    starts = ~letter & ((data & 0xC0) != 0x80)
    starts[:1] |= letter[:1]
    starts[1:] |= letter[1:] & ~letter[:-1]
    return np.flatnonzero(starts)


def draws(doc_id: object, salt: str) -> tuple[int, int, int, int]:
    """The four numbers that decide on a document, whichever task it is in."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{salt}:{name}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def transform(text: bytes, chosen: tuple[int, int, int, int]) -> tuple:
    """Units, form, prefix and middle in code points, the same in bytes, and the output."""
    data = np.frombuffer(text, np.uint8)
    starts = unit_starts(data)
    n = len(starts)
    if not text or any(mark in text for mark in MARKS) or chosen[2] % 100 >= PLAIN_FROM:
        return n, "plain", None, None, None, None, text
    first, last = sorted((chosen[0] % (n + 1), chosen[1] % (n + 1)))
    cuts = np.append(starts, len(text))[[first, last]]
    a, b = cuts.tolist()
    to, till = ExceptionIndex(data).to_chars(cuts).tolist()
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKS
    if chosen[3] % 100 < SPM_BELOW:
        form, parts = "spm", (s, suffix, p, prefix, m, middle)
    else:
        form, parts = "psm", (p, prefix, s, suffix, m, middle)
    return n, form, to, till - to, a, b - a, b"".join(parts)


def fill_in_middle(documents: DataFrame, salt: str = "1", text: str = "text") -> DataFrame:
    """Every document in the form that its id draws: ``plain``, ``psm`` or ``spm``, with its cuts.

    One row per row: doc_id, n (units), form, the lengths of prefix and middle in code points and in
    bytes (null if plain), and ``output``. A null text is empty, and an empty text plain. Repeated rows
    give equal rows; a null id draws as an empty id does; an empty table gives no row; further columns
    are ignored. A task holds one text at a time beside its batch, however long.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    fields = (f"doc_id {kind}, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, "
              "prefix_bytes BIGINT, middle_bytes BIGINT, output STRING")

    def run(batches: Iterator) -> Iterator:
        for batch in smaller(batches):
            ids = batch.column(0)
            rows = [transform(value, draws(doc_id, salt))
                    for doc_id, value in zip(ids.to_pylist(), texts_of(batch.column(1)))]
            n, form, *sizes, output = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 *(pa.array(size, pa.int64()) for size in sizes),
                 pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes",
                       "middle_bytes", "output"])

    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, fields)


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone. No part holds a mark and no mark overlaps another, so the
    first place of each mark is the one that was put there."""
    p, s, m = (F.locate(mark.decode(), output) for mark in MARKS)

    def between(start: Column, end: Column) -> Column:
        return F.substring(output, start + 3, end - start - 3)

    middle = F.substring(output, m + 3, F.length(output))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
        .otherwise(F.concat(between(p, m), middle, between(s, p)))
    )


def digests(documents: DataFrame, salt: str = "1") -> DataFrame:
    """What each document became, with digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(documents, salt)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
