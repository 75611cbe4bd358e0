"""Packing token pieces into sequences by minimum bin slack.

How pieces fill a sequence depends on nothing but their lengths, and there are at most
``SEQUENCE_LENGTH`` of those. So Spark counts pieces by length, the plan is made from these counts,
and every piece finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from footfall.llm.common import stage
from footfall.llm.tokens import ID_BYTES, SEQUENCE_LENGTH, WordCoder, pieces

Segment = tuple[int, int, int, int, int]


def fullest(counts: dict[int, int], room: int) -> Counter:
    """The combination of the lengths at hand that fills ``room`` best.

    Bit ``s`` of a number says that some combination has the sum ``s``. Lengths enter from the
    longest down, multiples by powers of two, until ``room`` itself is reached.
    """
    mask, reached, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left and not reached >> room & 1:
            take = min(times, left)
            steps.append((length, take, reached))
            reached |= reached << (length * take) & mask
            left, times = left - take, times * 2
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return chosen


def packing_plan(counts: dict[int, int], capacity: int = SEQUENCE_LENGTH
                 ) -> tuple[dict[int, list[Segment]], int]:
    """Where the pieces of each length go, and the number of sequences.

    Sequence by sequence the longest piece left is set and the rest of the room is filled as far
    as it can be; the same filling is repeated while the pieces for it last, so the plan's size
    follows the number of lengths, not of pieces. A length's pieces from rank ``first`` to ``end``
    lie ``copies`` to a sequence, from sequence ``sequence`` on, at ``offset``.
    """
    left = Counter({length: n for length, n in counts.items() if n})
    ranks: Counter = Counter()
    segments: dict[int, list[Segment]] = {length: [] for length in left}
    sequence = 0
    order = sorted(left, reverse=True)
    for longest in order:
        while left[longest]:
            left[longest] -= 1
            filling = fullest({x: n for x, n in left.items() if n}, capacity - longest)
            left[longest] += 1
            filling[longest] += 1
            times = min(left[length] // n for length, n in filling.items())
            offset = 0
            for length, copies in sorted(filling.items(), reverse=True):
                first = ranks[length]
                ranks[length] += copies * times
                left[length] -= copies * times
                segments[length].append((first, ranks[length], copies, sequence, offset))
                offset += copies * length
            sequence += times
    return segments, sequence


def token_pieces(documents: DataFrame, tokenizer: str, longest: int = SEQUENCE_LENGTH,
                 with_ids: bool = False, text: str = "text") -> DataFrame:
    """Pieces of every document's ids with length, checksum and rank within their task and length.

    ``with_ids`` adds the ids themselves as little-endian 32-bit numbers. A null text is empty and
    has the closing id only.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    fields = (f"doc_id {kind}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, "
              "task INT, nth BIGINT" + (", ids BINARY" if with_ids else ""))

    def run(batches: Iterator) -> Iterator:
        coder, task, seen = WordCoder.of(tokenizer), TaskContext.get().partitionId(), Counter()
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    ("doc_id", batch.schema.field(0).type), ("piece", pa.int32()),
                    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("task", pa.int32()), ("nth", pa.int64()),
                    *([("ids", pa.binary())] if with_ids else [])])
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), coder.texts(batch.column(1))):
                for number, start, ids in pieces(value, longest):
                    length = len(ids) // ID_BYTES
                    rows.append((doc_id, number, start, length, zlib.crc32(ids), task,
                                 seen[length], *([ids] if with_ids else [])))
                    seen[length] += 1
            columns = zip(*rows) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema)],
                schema=schema)

    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, fields)


def place(found: DataFrame, capacity: int = SEQUENCE_LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a staged table of pieces.

    A piece's rank is its rank within its task plus the pieces of its length in earlier tasks,
    summed over one row per task and length. The histogram of lengths is all the driver sees.
    """
    by_task = found.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = by_task.select(
        "length", "task",
        (F.sum("n").over(W.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    histogram = {row["length"]: row["n"] for row in
                 found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments, _ = packing_plan(histogram, capacity)
    plan = {length: np.array(rows, np.int64).T for length, rows in segments.items()}
    carried = [c for c in found.columns if c not in ("task", "nth")]
    ranked = found.join(before, ["length", "task"]).select(
        *carried, (F.col("before") + F.col("nth")).alias("rank"))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, starts = np.unique(length[order], return_index=True)
            for value, rows in zip(kinds, np.split(order, starts[1:])):
                first, _, copies, begin, at = plan[int(value)]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                nth = rank[rows] - first[k]
                sequence[rows] = begin[k] + nth // copies[k]
                offset[rows] = at[k] + nth % copies[k] * value
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(sequence), pa.array(offset)],
                names=[*carried, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema
                       if f.name in carried)
    return ranked.mapInArrow(run, f"{schema}, sequence_id BIGINT, offset BIGINT")


def best_fit_packing(documents: DataFrame, tokenizer: str, capacity: int = SEQUENCE_LENGTH,
                     with_ids: bool = False, text: str = "text") -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as the method finds.

    One row per piece. A null or empty text is the closing id alone; repeated rows and null ids are
    packed like others; an empty table gives no row; further columns are ignored.
    """
    found = stage(token_pieces(documents, tokenizer, capacity, with_ids, text), "pieces")
    return place(found, capacity)
